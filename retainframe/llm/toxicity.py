"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

Method: a character trigram model is counted over all documents. A word that looks disguised (letters mixed with
look-alike digits and signs, look-alikes alone, letters drawn out or doubled, letters set apart) becomes a lattice: each written
character may stand for itself, for a letter it looks like, or for nothing (a separator, a repetition, an outer sign). The Viterbi
path of best channel and model probability is the restored word. Where signs end a word, the reading that keeps them as letters
counts as well if the model finds it plausible; look-alikes alone and three letters set apart are read only then. A regression on the words and character
n-grams of restored texts, fitted on a bounded sample of labelled rows (``PER_CLASS`` of each label),
gives the score.

Edge cases: null and empty texts have no words and get the score of the offset alone; any length is read whole;
repeated rows give repeated results; without labels of both kinds every score is the share of label 1 (0 without
any label); an empty table gives an empty result. Only key, text and label columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks
from .labelled import Rows, fit_logistic, sample_labels, sigmoid

#: Sampled labelled rows of each label; evidence (log-likelihood ratio) and rows that make a feature count, and how many features.
PER_CLASS, EVIDENCE, LEAST_ROWS, FEATURES = 2_000, 20.0, 3, 4_096
THRESHOLD = 0.3

# What written characters may stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
SEPARATORS = " .-_*~'`^,:;/\\"
#: Log probabilities of the channel.
AS_IS, LOOK_ALIKE, DROPPED, KEPT_GAP, REPEATED = -0.05, -0.7, -0.3, -1.5, -0.4
#: Mean log probability a character from which a reading is plausible, its least length, and what leaving out a doubled letter must gain.
PLAUSIBLE, LEAST_READ, GAIN = -2.8, 3, 3.0

#: Characters of the model: 0 is a word's edge, then a-z, then the letters from U+00DF to U+00FF, then any other letter.
EDGE, OTHER, SIZE = 0, 60, 64
_CODES = np.zeros(0x110000, dtype=np.uint8)
for _c in range(0x80, 0x3000):
    if chr(_c).isalpha():
        _CODES[_c] = OTHER
_CODES[0x3000:0xE000] = OTHER
for _i, _c in enumerate([*range(97, 123), *(c for c in range(0xDF, 0x100) if c != 0xF7)], start=1):
    _CODES[_c] = _i


def code(c: str) -> int:
    return int(_CODES[ord(c)])


# --- character model -----------------------------------------------------------------------------------------


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of character triples of lower-cased words, edges included."""
    codes = _CODES[np.frombuffer("\n\n".join(["", *texts, ""]).lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].astype(np.int64)
    triples = codes[:-2] * (SIZE * SIZE) + codes[1:-1] * SIZE + codes[2:]
    return np.bincount(triples[(codes[1:-1] != EDGE) | (codes[2:] != EDGE)], minlength=SIZE**3)


def count_trigrams(df: DataFrame, text: str = "text") -> np.ndarray:
    """Triples of all rows; each task adds up its own, and at most SIZE**3 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, dtype=np.int64)
        for batch in batches:
            for i, j in chunks(batch, "text", 1 << 21):
                total += trigram_counts([t or "" for t in batch.column("text").slice(i, j - i).to_pylist()])
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["cell", "n"])

    out = np.zeros(SIZE**3, dtype=np.int64)
    for r in df.select(F.col(text).alias("text")).mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), interpolated between triples, pairs and single characters."""
    three = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 0.5) / (one.sum() + 0.5 * SIZE)
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


# --- channel -------------------------------------------------------------------------------------------------

_LETTERS = "a-zß-öø-ÿ"
_WORD = re.compile(rf"[{_LETTERS}]+")
_OUTER = "\"'.,;:!?()[]{}<>«»¡¿#%&*=~`^|/\\_-+$€@"
_TRAILING = "\"'.,;:!?()[]{}<>«»#%&*=~`^|/\\_-+$€@"
_PLAIN_END = _TRAILING.translate({ord(c): None for c in LOOKS_LIKE})
_LONG = re.compile(r"(.)\1\1", re.S)
_DOUBLED = re.compile(rf"([{_LETTERS}])\1")
_SIGNS = "@$€!|(+"
_LEADING = _OUTER.translate({ord(c): None for c in _SIGNS})
#: Three or more single characters set apart by separators.
_APART = re.compile(r"(?<!\S)[^\s.\-_*](?:[ .\-_*]{1,4}[^\s.\-_*]){2,}(?=[.,;:!?]?(?:\s|$))")


def plausible(word: str, model: np.ndarray) -> bool:
    """Whether the model expects a word like this."""
    if len(word) < LEAST_READ:
        return False
    codes = [EDGE, EDGE, *map(code, word), EDGE]
    return sum(float(model[codes[i - 2], codes[i - 1], codes[i]]) for i in range(2, len(codes))) >= PLAUSIBLE * (len(word) + 1)


def together(lower: str, model: np.ndarray) -> str:
    """A lower-cased text whose characters set apart are joined; three only to a plausible word."""

    def join(m: re.Match) -> str:
        found = restore_span(m[0], model)
        return found if sum(c not in " .-_*" for c in m[0]) > LEAST_READ or plausible(found, model) and " " not in found else m[0]

    return _APART.sub(join, lower) if _APART.search(lower) else lower


def restore_span(span: str, model: np.ndarray, head: int = 0, tail: int = 0, repeats: bool = True) -> str:
    """The best reading of a disguised span: Viterbi over (last two characters) with what each character may be.

    The first ``head`` and last ``tail`` characters are outer signs, which may also stand for nothing; without
    ``repeats`` no character counts as a repetition.
    """
    paths: dict[tuple[int, int], tuple[float, tuple | None, str]] = {(EDGE, EDGE): (0.0, None, "")}
    before = ""
    for i, c in enumerate(span):
        choices: list[tuple[str, float]] = []
        if c in SEPARATORS:
            choices = [("", DROPPED), (" ", KEPT_GAP)]
        else:
            own = code(c)
            if own:
                choices.append((c, AS_IS))
                if repeats and c == before:
                    choices.append(("", REPEATED))
            for x in LOOKS_LIKE.get(c, ""):
                choices.append((x, LOOK_ALIKE))
                if repeats and c == before:
                    choices.append(("", REPEATED))
            if not choices or i < head or i >= len(span) - tail:
                choices.append(("", DROPPED))
        before, grown = c, {}
        for (a, b), (score, back, out) in paths.items():
            for x, cost in choices:
                if not x:
                    state, total = (a, b), score + cost
                else:
                    k = EDGE if x == " " else code(x)
                    if k == EDGE and b == EDGE:
                        continue
                    state, total = (b, k), score + cost + float(model[a, b, k])
                if state not in grown or total > grown[state][0]:
                    grown[state] = (total, (back, out), x)
        paths = grown or paths
    best = max(paths.items(), key=lambda p: p[1][0] + float(model[p[0][0], p[0][1], EDGE]))[1]
    letters, back = [best[2]], best[1]
    while back:
        letters.append(back[1])
        back = back[0]
    return "".join(reversed(letters)).strip()


def disguised(core: str) -> bool:
    """Whether a token without outer signs mixes letters with look-alikes or separators, or draws letters out."""
    if core.isalpha():
        return _LONG.search(core) is not None
    return _WORD.search(core) is not None and (_LONG.search(core) is not None or any(c in LOOKS_LIKE or c in "*_.-~^" for c in core))


@dataclass
class Restorer:
    """Restores texts; what tokens become is remembered for a bounded number of tokens."""

    model: np.ndarray
    remember: int = 200_000
    young: dict = field(default_factory=dict)
    old: dict = field(default_factory=dict)

    def __post_init__(self):
        m = self.model
        # what leaving out the second of two equal letters c gains between a and d
        self.gain = m + REPEATED - np.einsum("acc->ac", m)[:, :, None] - np.einsum("ccd->cd", m)[None]

    def doubled(self, word: str) -> bool:
        """Whether the model prefers the word without one of its doubled letters, by far."""
        if not _DOUBLED.search(word):
            return False
        codes = [EDGE, *map(code, word), EDGE]
        return any(codes[i] == codes[i + 1] and self.gain[codes[i - 1], codes[i], codes[i + 2]] >= GAIN for i in range(1, len(codes) - 2))

    def kept(self, core: str) -> list[str]:
        """Plausible readings in which no outer sign is left out, with and without repetitions."""
        both = dict.fromkeys((restore_span(core, self.model), restore_span(core, self.model, repeats=False)))
        return [x for x in both if plausible(x, self.model)]

    def read(self, token: str) -> tuple[str, str]:
        """The restored token, and other plausible readings or nothing."""
        core = token.lstrip(_LEADING).rstrip(_PLAIN_END)
        if not core:
            return token, ""
        bare = core.lstrip(_SIGNS).rstrip(_TRAILING)
        if not _WORD.search(bare):
            if all(c in LOOKS_LIKE for c in core):
                if found := self.kept(core):
                    return found[0], " ".join(found[1:])
            core = token.lstrip(_LEADING).rstrip(_TRAILING)
            return (restore_span(core, self.model) if core and disguised(core) else token), ""
        head, tail = len(core) - len(core.lstrip(_SIGNS)), len(core) - len(core.rstrip(_TRAILING))
        plain = not disguised(bare) and not self.doubled(bare)
        if not (head or tail):
            return (token if plain else restore_span(core, self.model)), ""
        found = restore_span(core, self.model, head, tail)
        return (token if plain and found == bare else found), " ".join(x for x in self.kept(core) if x != found)

    def readings(self, token: str) -> tuple[str, str]:
        found = self.young.get(token)
        if found is None:
            found = self.old.get(token)
            if found is None:
                found = self.read(token)
            if len(self.young) >= self.remember:
                self.old, self.young = self.young, {}
            self.young[token] = found
        return found

    def token(self, token: str) -> str:
        """The restored token, lower-cased; a plain one comes back as it is."""
        return self.readings(token)[0]

    def text(self, text: str | None) -> str:
        """Whole text, lower-cased, its disguised spans restored and white space of tokens kept as one space."""
        lower = together((text or "").lower(), self.model)
        return " ".join(map(self.token, lower.split()))

    def words(self, text: str | None) -> set[str]:
        lower = together((text or "").lower(), self.model)
        return set().union(*(self.split(t) for t in set(lower.split()))) if lower else set()

    def split(self, token: str) -> list[str]:
        best, other = self.readings(token)
        return _WORD.findall(best) + _WORD.findall(other)


def word_features(word: str) -> set[int]:
    """Hashes of a word, of its character 4- and 5-grams, edges marked, and of what it begins with."""
    marked = f"^{word}$"
    grams = {marked, *(marked[i : i + n] for n in (4, 5) for i in range(len(marked) - n + 1))}
    return {zlib.crc32(g.encode()) for g in grams}


# --- score ---------------------------------------------------------------------------------------------------


@dataclass
class Model:
    language: np.ndarray
    weights: dict[int, float]
    offset: float


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _evidence(present: np.ndarray, absent: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Log-likelihood ratio of a feature's rows with label 1 and 0 against no connection."""
    def term(k, n):
        with np.errstate(divide="ignore", invalid="ignore"):
            p = k / n
            return np.where(k > 0, k * np.log(p), 0) + np.where(n - k > 0, (n - k) * np.log1p(-p), 0)

    both = present + absent
    return 2 * (term(present, n1) + term(absent, n0) - term(both, n1 + n0))


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", per_class: int = PER_CLASS, corpus: DataFrame | None = None) -> Model:
    """Character model from all of ``corpus`` (or ``documents``), score from a bounded sample of labelled rows."""
    language = log_model(count_trigrams(documents if corpus is None else corpus, text))
    chosen, counts = sample_labels(labels, key, label, per_class)
    share = (counts[1] + 1e-6) / (counts[0] + counts[1] + 1)
    base = Model(language, {}, float(np.log(share / (1 - share))))
    if not (counts[0] and counts[1]):
        return base
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")  # bounded by per_class

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(language)
        for batch in batches:
            found = [np.fromiter(set().union(*map(word_features, restorer.words(t.as_py()))) or (), dtype=np.uint32) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key").cast(pa.string()), batch.column("label"), pa.array([f.tobytes() for f in found], pa.binary())], names=["key", "label", "features"])

    got = sorted(rows.mapInArrow(run, "key string, label int, features binary").collect(), key=lambda r: r["key"])
    y = np.array([r["label"] for r in got], dtype=np.int64)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not (n1 and n0):
        return base
    found = [np.frombuffer(r["features"], np.uint32) for r in got]
    names = {k: np.unique(np.concatenate([f for f, v in zip(found, y) if v == k]), return_counts=True) for k in (0, 1)}
    known, present = names[1]
    at = np.minimum(np.searchsorted(names[0][0], known), max(len(names[0][0]) - 1, 0))
    absent = np.where(names[0][0][at] == known, names[0][1][at], 0) if len(names[0][0]) else np.zeros(len(known), int)
    weight = _evidence(present, absent, n1, n0)
    usable = np.flatnonzero((present >= LEAST_ROWS) & (weight >= min(EVIDENCE, 0.5 * n1)) & (present * n0 > absent * n1))
    best = np.sort(known[usable[np.argsort(-weight[usable], kind="stable")[:FEATURES]]])
    if not len(best):
        return base
    cells = [np.searchsorted(best, f[np.isin(f, best)]) for f in found]
    w, b = fit_logistic(Rows(cells, [np.ones(len(c)) for c in cells]), y, len(best), 1e-3, steps=300)
    b += float(np.log((counts[1] / counts[0]) / (n1 / n0)))  # the sample is balanced: back to the shares among all labelled rows
    return Model(language, {int(k): float(v) for k, v in zip(best, w)}, float(b))


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the probability that its text has label 1; a column of that name is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # fixed bounds: SIZE**3 cells and FEATURES weights
    schema = T.StructType([f for f in df.schema if f.name.lower() != name.lower()] + [T.StructField(name, T.DoubleType(), False)])
    others = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        restorer, weights = Restorer(known.language), known.weights
        young: dict[str, frozenset] = {}
        old: dict[str, frozenset] = {}
        nothing: frozenset = frozenset()
        for batch in batches:
            z = np.full(batch.num_rows, known.offset)
            for i, t in enumerate(batch.column(text)):
                lower = together((t.as_py() or "").lower(), known.language)
                hits: set[int] = set()
                for token in set(lower.split()):
                    found = young.get(token)
                    if found is None:
                        found = old.get(token)
                        if found is None:
                            found = frozenset(k for w in restorer.split(token) for k in word_features(w) if k in weights) or nothing
                        if len(young) >= 200_000:
                            old, young = young, {}
                        young[token] = found
                    if found:
                        hits |= found
                z[i] += sum(weights[k] for k in sorted(hits))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(sigmoid(z))], names=schema.names)

    return df.mapInArrow(run, schema)


def restored(df: DataFrame, language: np.ndarray, text: str = "text", name: str = "restored") -> DataFrame:
    """``df`` with the restored text in column ``name``."""
    schema = T.StructType([f for f in df.schema if f.name.lower() != name.lower()] + [T.StructField(name, T.StringType(), False)])
    others = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(language)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array([restorer.text(t.as_py()) for t in batch.column(text)], pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)
