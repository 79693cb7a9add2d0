"""Small hard inputs shared by the operator tests."""

import random

CLASHING = "doc_id long, text string, row long, key string, score double, n_lines string, range int, block string, part int, t string"


def edge_documents(spark, more=()):
    """Null and empty texts, a null id, a repeated row, a very long text, and columns named like internal ones."""
    long = "word " * 30_000 + "x" * 20_000
    texts = [(1, None), (2, ""), (3, " \n\t"), (None, "a text without an id, long enough to hold a few words of its own"), (4, "same row"), (4, "same row"), (5, long), *more]
    return spark.createDataFrame([(i, t, 7, "k", 0.5, "l", 3, "b", 1, "t") for i, t in texts], CLASHING)


def no_documents(spark):
    return spark.createDataFrame([], CLASHING)


def babble(rng: random.Random, words: int, syllables=("ka", "lo", "mi", "ne", "pu", "ra", "so", "ti", "ve", "zu")) -> str:
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words))


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
