"""Secret scan in DataFrame operations only: fixed patterns, and windows of high entropy in candidate strings.

Method: candidate strings are unbroken runs of key characters. Each is read by a sliding window whose character
counts change by one in and one out; the sum of c * log2 c, and with it the Shannon entropy, follows from these
two counts alone. Windows whose entropy reaches the limit of the string's character class are merged to spans.
Strings on the allow list (plain words, numbers, placeholders, sequences, paths, addresses) are not read.

Positions come from the lengths of what lies between matches, added up per document by a window function, so
that a document with very many matches costs no more per match than one with few.

Edge cases: null counts as the empty text and has no finding; a text of any length is scanned whole; repeated
rows, also with equal or null keys, are documents of their own; an empty table gives an empty result. Only the key and
text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retainframe.functions import bind

KINDS = ("assign", "access", "hex", "entropy")
# What the base rules look for. Runs of digits and a-f are found at once from the least length.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
LEAST_ASSIGNED = 6
#: Candidate strings, the window, and entropy in bits from which a window of a class is a finding.
CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
WIDTH = 20
LIMITS = {"hex": ("^[0-9a-fA-F]+$", 3.0), "upper": ("^[A-Z0-9]+$", 3.6), "mixed": ("^.+$", 3.85)}
# What hides the text it touches: placeholders, sequences, dates; letters or digits alone between separators are words.
_HARMLESS = r"(?i:example|sample|dummy|placeholder|changeme|your[_-]|xxxx|0000000|abcdefgh)|0123456789|12345678|[0-9]{4}-[0-9]{2}-[0-9]{2}"
_WORD = "(?<![A-Za-z0-9+])(?:[A-Za-z]{1,15}|[0-9]+)(?![A-Za-z0-9+])"
#: No window's length of other text follows the start, a separator or a placeholder.
_NOTHING_BESIDE = f"(?!.*(?:^|[_/=-]|{_HARMLESS})(?:(?!{_HARMLESS}|{_WORD}).){{20}})"
#: Letters that read as words: no long runs of consonants, case changes not at every other letter.
_READABLE = "(?!.*(?:[bcdfghjklmnpqrstvwxz]{5}|[BCDFGHJKLMNPQRSTVWXZ]{6}|(?i:[bcdfghjklmnpqrstvwxz]{7})|[a-z][A-Z]{1,2}[a-z]{1,2}[A-Z]{1,2}[a-z]{1,2}[A-Z]))"
#: Candidates that are no secrets as a whole: words, no letter, placeholders and sequences and dates with nothing beside them, unique ids, paths of words.
ALLOWED = (
    f"^{_READABLE}[^0-9]+$",
    "^[^A-Za-z]+$",
    f"^(?=.*(?i:example|sample|dummy|placeholder|changeme|your[_-]|xxxx|0000000)){_NOTHING_BESIDE}.+$",
    f"^(?=.*(?:0123456789|(?i:abcdefgh)|12345678)){_NOTHING_BESIDE}.+$",
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    f"^(?=[A-Za-z]*[-_/]?[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}){_NOTHING_BESIDE}.+$",
    f"^{_READABLE}/?([A-Za-z]+[/_=-])+[A-Za-z]*[0-9]{{0,4}}$",
)


def _weight(n: Column) -> Column:
    """n * log2 n, 0 for n = 0."""
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def entropy_spans(text: Column, width: int = WIDTH) -> Column:
    """Array of (s, e): merged places of the windows of ``text`` whose entropy reaches the limit of its class."""
    limit = F.lit(LIMITS["mixed"][1])
    for pattern, bits in (LIMITS["upper"], LIMITS["hex"]):
        limit = F.when(text.rlike(pattern), F.lit(bits)).otherwise(limit)
    letters = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(CHARACTERS), c))
    letters = F.filter(letters, lambda k: k > 0)  # a trailing empty piece

    def step(letters: Column, limit: Column, state: Column, i: Column) -> Column:
        came = F.element_at(letters, i)
        went = F.when(i > width, F.element_at(letters, F.greatest(i - width, F.lit(1)))).otherwise(F.lit(0))
        n_in, n_out = F.element_at(state["counts"], came), F.when(went > 0, F.element_at(state["counts"], F.greatest(went, F.lit(1)))).otherwise(F.lit(0))
        same = came == went
        total = F.when(same, state["total"]).otherwise(state["total"] + _weight(n_in + 1) - _weight(n_in) + F.when(went > 0, _weight(n_out - 1) - _weight(n_out)).otherwise(F.lit(0.0)))
        counts = F.when(same, state["counts"]).otherwise(F.transform(state["counts"], lambda n, k: n + F.when(k + 1 == came, 1).otherwise(0) - F.when(k + 1 == went, 1).otherwise(0)))
        high = (i >= width) & (F.lit(float(width)) * (F.log2(F.lit(float(width))) - limit) >= total - F.lit(1e-9))
        spans, n = state["spans"], F.size(state["spans"])
        joins = (n > 0) & (F.element_at(spans, F.greatest(n, F.lit(1)))["e"] >= i - width)
        grown = F.when(joins, F.concat(F.slice(spans, 1, F.greatest(n - 1, F.lit(0))), F.array(F.struct(F.element_at(spans, F.greatest(n, F.lit(1)))["s"].alias("s"), i.alias("e"))))).otherwise(F.concat(spans, F.array(F.struct((i - width).alias("s"), i.alias("e")))))
        return F.struct(counts.alias("counts"), total.alias("total"), F.when(high, grown).otherwise(spans).alias("spans"))

    start = F.struct(
        F.array_repeat(F.lit(0), len(CHARACTERS)).alias("counts"), F.lit(0.0).alias("total"),
        F.array().cast("array<struct<s:int,e:int>>").alias("spans"),
    )
    # letters and limit are bound outside the fold: what a step carries on does not grow with the string
    fold = lambda known, bits: F.aggregate(F.sequence(F.lit(1), F.size(known)), start, lambda state, i: step(known, bits, state, i), lambda state: state["spans"])
    return bind(letters, lambda known: bind(limit, lambda bits: fold(known, bits)))


def _matches(kind: int, hits: Column, inner: Column, gaps: Column) -> Column:
    """Array of (kind, i, gap, n, inner, value): each match with the length of what lies before it."""
    return F.transform(
        F.arrays_zip(hits.alias("hit"), inner.alias("inner"), F.slice(gaps, 1, F.size(hits)).alias("gap")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("n"), F.length(x["inner"]).alias("inner"), (x["hit"] if kind == 3 else F.lit("")).alias("value")),
    )


def findings(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row, key, kind, s, e): every finding with its place in code points, end exclusive; kind is null in one more row per document."""
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    patterns = (ASSIGN, ACCESS, HEX, CANDIDATE)
    for k, pattern in enumerate(patterns):
        rows = rows.withColumn(f"hits{k}", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    rows = rows.withColumn("inner0", F.when(F.size("hits0") > 0, F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1))).otherwise(F.col("hits0")))
    for k, pattern in enumerate(patterns):
        rows = rows.withColumn(f"gaps{k}", F.when(F.size(f"hits{k}") > 0, F.split("text", pattern, -1)).otherwise(F.col(f"hits{k}")))
    end = F.array(F.struct(F.lit(None).cast("int").alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit(0).alias("n"), F.lit(0).alias("inner"), F.lit("").alias("value")))
    every = F.concat(*[_matches(k, F.col(f"hits{k}"), F.col("inner0" if k == 0 else f"hits{k}"), F.col(f"gaps{k}")) for k in range(4)], end)
    each = rows.select("row", "key", F.explode(every).alias("x")).select("row", "key", "x.*")
    until = F.sum(F.col("gap") + F.col("n")).over(Window.partitionBy("row", "kind").orderBy("i"))
    placed = each.withColumn("e", until.cast("int")).withColumn("s", F.col("e") - F.col("n"))
    placed = placed.where(F.col("kind").isNull() | (F.col("kind") != 0) | (F.col("inner") >= LEAST_ASSIGNED))
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | F.col("value").rlike(pattern)
    inside = F.when((F.col("kind") == 3) & ~allowed, entropy_spans(F.col("value"))).when(F.col("kind") == 3, F.array().cast("array<struct<s:int,e:int>>"))
    whole = F.array(F.struct(F.lit(0).alias("s"), F.col("n").alias("e")))
    spans = placed.withColumn("span", F.explode(F.coalesce(inside, whole)))
    return spans.select("row", "key", "kind", (F.col("s") + F.col("span.s")).alias("s"), (F.col("s") + F.col("span.e")).alias("e"))


def secret_table(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: its key, counts of the base kinds, and all spans as an array of (s, kind, e) in order."""
    found = F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("s", "kind", "e"))))
    count = lambda k: F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k]}")
    return findings(df, text, key).groupBy("row", "key").agg(count(0), count(1), count(2), count(3), found.alias("spans")).drop("row").withColumnRenamed("key", key)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")
