"""Secret scans: fixed patterns, and strings that a Markov model of random strings fits better than ordinary words.

Two character models of order one are trained on labelled samples: random strings (drawn from the alphabets of
keys by a fixed seed) and ordinary identifiers (those of all whole texts that no pattern marks, summed up within the
tasks). A long run of key characters is a secret where its mean log-likelihood ratio is above a threshold.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The kinds in their order, with their patterns. Runs are taken whole, so the length of a hex run or
#: an access key is asked for in the pattern; that of an assigned value is checked afterwards.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
SHORTEST = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
#: Alphabets of keys.
ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping for each kind."""
    out: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return out + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def pairs_of(strings: Iterable[str]) -> np.ndarray:
    """How often a character follows another (ASCII; 0 stands for the start and for what is beyond), for all strings."""
    raw = ("\0" + "\0".join(strings)).encode("ascii", "replace").replace(b"?", b"\0")
    codes = np.frombuffer(raw, np.uint8).astype(np.int64)
    keep = codes[1:] != 0  # a start, and what is beyond, follow nothing
    return np.bincount(codes[:-1][keep] * 128 + codes[1:][keep], minlength=128 * 128).reshape(128, 128)


def transitions(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities of a character after another."""
    n = counts + 0.05
    return np.log(n / n.sum(axis=1, keepdims=True))


def train(ordinary: np.ndarray | Iterable[str], seed: int = 7, per_alphabet: int = 2000) -> np.ndarray:
    """The table of log-likelihood ratios of transitions, random strings over ordinary identifiers.

    The samples of random strings are drawn, so they are labelled; those of ``ordinary`` are strings, or counts of pairs.
    """
    rng = random.Random(seed)
    strings = ["".join(rng.choices(a, k=32)) for a in ALPHABETS for _ in range(per_alphabet)]
    return transitions(pairs_of(strings)) - transitions(ordinary if isinstance(ordinary, np.ndarray) else pairs_of(ordinary))


def mean_ratio(model: np.ndarray, s: str) -> float:
    codes = np.frombuffer(("\0" + s).encode("ascii", "replace"), dtype=np.uint8)
    return float(model[codes[:-1], codes[1:]].mean())


RUN, DIGIT = re.compile(r"[A-Za-z0-9+/_=-]+"), re.compile(r"[0-9]")


def ordinary_pairs(docs: DataFrame) -> np.ndarray:
    """Pairs of characters in the runs of key characters that no pattern marks, over all whole texts.

    The patterns label the runs: one that they mark is a secret, any other an ordinary identifier. A run of CANDIDATE's length
    with both digits and letters may be either and counts for neither. Each task adds up a table, tables are summed
    up by rows, and one table of 128 x 128 sums reaches the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((128, 128), np.int64)
        for b in batches:
            for text in b.column("text").to_pylist():
                if text:
                    marked = base_spans(text)
                    plain = "\0".join(cut_out(text, marked)) if marked else text
                    total += pairs_of(s for s in RUN.findall(plain) if len(s) < SHORTEST or s.isdigit() or not DIGIT.search(s))
        rows = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(total[rows].tolist(), pa.list_(pa.int64()))], ["row", "sums"])

    parts = docs.select("text").mapInArrow(count, "row long, sums array<long>")
    out = np.zeros((128, 128), np.int64)
    for r in parts.select("row", F.posexplode("sums").alias("col", "n")).groupBy("row", "col").agg(F.sum("n").alias("n")).where("n > 0").collect():
        out[r.row, r.col] = r.n
    return out if out.any() else pairs_of(["the", "of", "and"])


def cut_out(text: str, spans: list[tuple[int, int, int]]) -> Iterator[str]:
    """What of a text stands outside all spans."""
    at = 0
    for s, _, e in sorted(spans):
        if s > at:
            yield text[at:s]
        at = max(at, e)
    yield text[at:]


def covered(spans: list[tuple[int, int, int]]) -> list[list[int]]:
    """The stretches [start, end] that spans cover, in order and apart."""
    out: list[list[int]] = []
    for s, _, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def all_spans(text: str, model: np.ndarray, threshold: float) -> list[tuple[int, int, int]]:
    """The base spans, and the runs of key characters that touch none of them and are likely random; one sweep over both in order."""
    base = base_spans(text)
    taken, i, more = covered(base), 0, []
    for m in CANDIDATE.finditer(text):
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        if i < len(taken) and taken[i][0] < m.end():
            continue
        s = m.group()
        if not s.isalpha() and not s.isdigit() and mean_ratio(model, s) > threshold:
            more.append((m.start(), 3, m.end()))
    return sorted(base + more)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def model_of(docs: DataFrame) -> np.ndarray:
    """The model for these texts."""
    return train(ordinary_pairs(docs))


def scan_secrets(docs: DataFrame, threshold: float = 0.5, model: np.ndarray | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with all its secrets; spans are in code points of the whole text.

    A null or empty text has none; texts of any length are read whole, in time that grows with it. A null doc_id stays
    null, repeated rows give repeated results, other columns are not read. An empty table gives no rows.
    """
    ratios = model_of(docs) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                spans = all_spans(text, ratios, threshold) if text else []
                n = [sum(k == i for _, k, _ in spans) for i in range(4)]
                rows.append((*n[:3], hashlib.sha256(joined([x for x in spans if x[1] < 3]).encode()).hexdigest(), joined(spans), n[3]))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]", threshold: float = 0.5, model: np.ndarray | None = None) -> DataFrame:
    """``docs`` with every secret of text replaced by ``mark`` (overlapping spans by one) and n_chars, if there, set anew.

    Texts without secrets and nulls stay as they are; all rows and columns stay.
    """
    ratios = model_of(docs) if model is None else model

    @F.pandas_udf("string")
    def cleaned(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda t: redacted(t, ratios, threshold, mark) if t else t)

    out = docs.withColumn("text", cleaned(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def redacted(text: str, model: np.ndarray, threshold: float, mark: str) -> str:
    out, at = [], 0
    end = -1
    for s, _, e in all_spans(text, model, threshold):
        if s >= end:
            out += [text[at:s], mark]
        end = at = max(end, e)
    return "".join(out) + text[at:] if out else text
