"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton over folded text.

Folding lower-cases, drops invisible characters, maps homoglyphs of other scripts and digit substitutions to the
letters they stand for. The lexicon is learned: words of a bounded sample of labelled rows get log-odds weights; where
many inflections share a stem that only toxic rows hold, the stem is the entry. Matches must start a word (and end one,
if the entry is a whole word) and not lie in an exception phrase. The summed weight and its density, normalised by the
text's length, go through a logistic curve fitted on the same sample.

Defined results: null and empty texts match nothing and get the curve's lowest score; texts are scanned whole; repeated
rows repeat; an empty table gives an empty table; without labelled toxic rows the lexicon is empty and all scores are
``NEUTRAL``; of equal labels the toxic one counts, of words with equal counts the first by code points; only ``id_col``,
``text_col`` and the labels' two columns are read; other columns pass through, but for those named like ``score_col``
and ``matches_col``, which give way to the results.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Saved, columns, map_texts, table

#: Labelled rows of each class that a fit uses at most (those with the smallest hash of their id).
SAMPLE_TOXIC, SAMPLE_CLEAN = 2_000, 4_000
#: An entry needs so many toxic rows, and so few clean rows for each of them. Stems are of these lengths.
LEAST_ROWS, CLEAN_SHARE, STEMS, INFLECTIONS = 6, 0.02, (3, 4, 5, 6, 7), 4
MOST_ENTRIES, NEUTRAL, REJECT = 5_000, 0.1, 0.7
#: Harmless phrases around words that are often entries.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "clownfish", "pond scum", "sympathetic", "empathetic")
#: Characters that are drawn like a Latin letter or put in its place.
LOOKALIKES = {
    "a": "аɑα4@", "b": "Ьβ", "c": "сϲ", "d": "ԁ", "e": "еҽε3€", "g": "ɡ9", "h": "һ", "i": "іıɩι1!|", "j": "ј", "k": "κк", "m": "м", "n": "ո", "o": "оοօσ0", "p": "рρ",
    "q": "ԛ", "r": "г", "s": "ѕ5$", "t": "тτ7", "u": "υս", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ᴢ",
}
_FOLD = {ord(x): k for k, xs in LOOKALIKES.items() for x in xs} | dict.fromkeys(map(ord, "​‌‍⁠﻿­"))
#: One letter for i and l, as 1 and | stand for both.
_FOLD[ord("l")] = "i"
_WIDE = re.compile("[！-～]")
_END = re.compile(r"[!|]+(?=\s|$)")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Punctuation that ends a word isn't a letter, within a word it is."""
    if "!" in text or "|" in text:
        text = _END.sub(" ", text)
    if _WIDE.search(text):
        text = _WIDE.sub(lambda m: chr(ord(m[0]) - 0xFEE0), text)
    return text.lower().translate(_FOLD)


@dataclass
class Lexicon:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (math.log(NEUTRAL / (1 - NEUTRAL)), 0.0, 0.0)

    def automaton(self):
        entries: dict[str, list] = {}
        for w, x in self.words.items():
            entries.setdefault(w, [0.0, 0.0, False])[0] = x
        for w, x in self.stems.items():
            entries.setdefault(w, [0.0, 0.0, False])[1] = x
        for w in self.exceptions:
            entries.setdefault(fold(w), [0.0, 0.0, False])[2] = True
        a = ahocorasick.Automaton()
        for w, x in entries.items():
            a.add_word(w, (len(w), *x))
        if entries:
            a.make_automaton()
        return a if entries else None


def matches(automaton, text: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the entries in folded text, one for a word, without those in exception phrases."""
    hits, safe, n = {}, [], len(text)
    for last, (k, word, stem, exception) in automaton.iter(text):
        start = last + 1 - k
        if exception:
            safe.append((start, last + 1))
        if start and text[start - 1].isalpha():
            continue
        w = max(stem, word if last + 1 == n or not text[last + 1].isalpha() else 0.0)
        if w and w > hits.get(start, (0, 0.0))[1]:
            hits[start] = (last + 1, w)
    return [(s, e, w) for s, (e, w) in sorted(hits.items()) if not any(a < e and s < b for a, b in safe)]


def features(automaton, text: str | None) -> tuple[float, float, int]:
    """log of 1 + summed weight, log of 1 + weight for each 100 words, matches."""
    if automaton is None or not text:
        return 0.0, 0.0, 0
    found = matches(automaton, fold(text))
    if not found:
        return 0.0, 0.0, 0
    total, words = sum(w for _, _, w in found), max(1, len(text.split()))
    return math.log1p(total), math.log1p(100 * total / words), len(found)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, float, float]:
    """Logistic regression by Newton steps; weights are kept at 0 or above: more matches never lower a score."""
    use = [0, 1, 2]
    beta = np.zeros(3)
    full = np.column_stack([np.ones(len(x)), x])
    for _ in range(2):
        beta[:] = 0
        for _ in range(50):
            a = full[:, use]
            p = 1 / (1 + np.exp(-np.clip(a @ beta[use], -30, 30)))
            h = a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.diag([1e-6, *[1.0] * (len(use) - 1)]) + 1e-9 * np.eye(len(use))
            step = np.linalg.solve(h, a.T @ (y - p) - ridge * beta[use] * np.array([0.0, *[1.0] * (len(use) - 1)]))
            beta[use] += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        if (beta[1:] >= 0).all():
            break
        use = [0, *(j for j in (1, 2) if beta[j] > 0)]
    return tuple(map(float, beta))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(y, text) of the labelled rows that a fit uses: bounded by SAMPLE_TOXIC and SAMPLE_CLEAN, so small enough to send to every task."""
    lab = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("double").alias("y")).groupBy("id").agg(F.max("y").alias("y"))
    pick = lambda y, n: lab.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
    chosen = pick(1.0, SAMPLE_TOXIC).unionAll(pick(0.0, SAMPLE_CLEAN))
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("y", "text")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    saved = Saved(docs.sparkSession)
    rows = saved(sample(docs, labels, id_col, text_col, label_col))

    def words(batches):
        for b in batches:
            out: dict[str, list[int]] = {}
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w in set(_WORD.findall(fold(t or ""))):
                    out.setdefault(w[:40], [0, 0])[int(y)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array([x[1] for x in out.values()], pa.int64()), pa.array([x[0] for x in out.values()], pa.int64())], ["word", "pos", "neg"])

    counts = map_texts(rows, words, "word string, pos bigint, neg bigint").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counts = saved(counts)
    n_pos, n_neg = (rows.agg(F.sum("y"), F.sum(1 - F.col("y"))).first())
    n_pos, n_neg = n_pos or 0, n_neg or 0
    good = (F.col("pos") >= LEAST_ROWS) & (F.col("neg") <= CLEAN_SHARE * F.col("pos") * F.lit(n_neg / max(1, n_pos)))
    stems = counts.select("pos", "neg", F.explode(F.expr(f"transform(filter(array{STEMS}, k -> k < length(word)), k -> substring(word, 1, k))")).alias("stem")).groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum((F.col("pos") > 1).cast("int")).alias("n"))
    top = lambda df: [tuple(r) for r in df.where(good).orderBy(F.desc("pos"), df.columns[0]).limit(MOST_ENTRIES).collect()]
    weigh = lambda p, n: math.log((p + 0.5) / (n_pos + 1)) - math.log((n + 0.5) / (n_neg + 1))
    # a word in less than one of 300 toxic rows may be there by chance
    lex_words = {w: weigh(p, n) for w, p, n in top(counts.select("word", "pos", "neg")) if p >= n_pos / 300 and n * n_pos <= CLEAN_SHARE * p * n_neg}
    found = {s: (p, n) for s, p, n, k in top(stems) if k >= INFLECTIONS and p >= n_pos / 150}
    keep = {s: weigh(p, n) for s, (p, n) in found.items() if not any(len(t) > len(s) and t.startswith(s) and q >= 0.95 * p for t, (q, _) in found.items())}
    out = Lexicon(lex_words, keep, exceptions)

    auto = out.automaton()

    def measure(batches):
        for b in batches:
            x = [features(auto, t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[j] for r in x], pa.float64()) for j in (0, 1))], ["y", "a", "b"])

    if n_pos and n_neg and (out.words or out.stems):
        got = np.array([tuple(r) for r in map_texts(rows, measure, "y double, a double, b double").collect()])
        got = got[np.lexsort(got.T)]
        out.curve = fit_curve(got[:, 1:], got[:, 0])
    saved.drop(rows, counts)
    return out


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", score_col: str = "_score", matches_col: str = "_matches") -> DataFrame:
    """docs with ``score_col`` and ``matches_col``. Narrow; the lexicon is bounded by MOST_ENTRIES."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (score_col, matches_col) or c == text_col])
    names, at = [*docs.columns, score_col, matches_col], docs.columns.index(text_col)

    def run(batches):
        auto = lexicon.automaton()
        c0, c1, c2 = lexicon.curve
        for b in batches:
            x = [features(auto, t) for t in b.column(at).to_pylist()]
            s = [1 / (1 + math.exp(-max(-30.0, min(30.0, c0 + c1 * u + c2 * v)))) for u, v, _ in x]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()), pa.array([r[2] for r in x], pa.int32())], names)

    return map_texts(docs, run, f"{columns(docs)}, `{score_col}` double, `{matches_col}` int")


def train_rows(labels: DataFrame) -> DataFrame:
    return labels.where(F.expr("crc32(cast(doc_id as string)) % 3 <> 1"))


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = learn(docs, train_rows(table(spark, sf_dir, "labels")))
    out = score(docs, lexicon)
    return out.select("doc_id", F.expr("coalesce(crc32(cast(doc_id as string)) % 3 = 1, false)").alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= REJECT).cast("int").alias("predicted"), F.col("_matches").alias("n_matches"))
