"""Language identification by Bloom filters whose rows are bitmasks of languages.

The n-grams are runs of ``GRAM`` bytes of the folded text with everything but letters as blanks. Each language has a
Bloom filter of its n-grams; the filters are sliced by bit, so that one row of the table holds the same bit of all
languages, and the conjunction of ``HASHES`` rows names all languages that contain an n-gram at once. A text's
language is the one with the most n-grams after the expected false positives are taken off every count.

An n-gram is learned for a language if it is in at least ``LEAST`` of its sampled documents (in all of them where there are
fewer, so that no language is without n-grams) and at least a quarter as frequent there as in any other language, which
leaves out what foreign passages bring along; the ``KEPT`` most frequent are taken. Frequencies are shrunk by ``SHRINK``
documents, so that a language of one or two documents does not take common n-grams from the others. The sample holds about ``SAMPLE`` documents of each language, chosen by hash. Whole texts are
identified, row by row, without a shuffle.

Rules for odd input: a null text or one without a letter is ``und`` with score 0; a text of unknown n-grams only gets
the most frequent language with score 0; equal counts go to the smaller name; null languages teach nothing; without
anything learned all is ``und``; repeated rows are identified row by row; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.text import Texts, U, slices

GRAM = 4
HASHES = 3
SAMPLE = 2_000
LEAST = 3
SHRINK = 8
KEPT = 20_000
UNKNOWN = "und"

_LETTER = np.full(256, 32, np.uint8)
for _low, _high, _shift in ((65, 90, 32), (97, 122, 0), (128, 255, 0)):
    _LETTER[_low : _high + 1] = np.arange(_low + _shift, _high + _shift + 1)


def grams(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Code of the n-gram at every byte, and whether it counts: inside its text, with two letter bytes at least."""
    folded = _LETTER[part.data]
    n = len(folded)
    code = np.zeros(n, np.uint32)
    letters = np.zeros(n, np.uint8)
    for step in range(GRAM):
        code[: n - step] |= folded[step:].astype(np.uint32) << np.uint32(8 * step)
        letters[: n - step] += folded[step:] != 32
    counts = letters >= 2
    for step in range(1, GRAM):
        late = part.bounds[1:] - step
        counts[late[late >= part.bounds[:-1]]] = False
    return code, counts


def _lettered(part: Texts) -> np.ndarray:
    """Texts with at least one letter."""
    ascii_ = part.total((_LETTER[part.data] != 32) & (part.data < 128)) > 0
    for i in np.flatnonzero(~ascii_ & (part.total(part.data >= 128) > 0)).tolist():
        ascii_[i] = any(map(str.isalpha, part.data[part.bounds[i] : part.bounds[i + 1]].tobytes().decode(errors="replace")))
    return ascii_


@dataclass
class Filters:
    """Bloom filters of all languages: ``rows[w][i]`` has bit i of the filters of languages 64 w to 64 w + 63."""

    names: list[str]
    fallback: str
    rows: list[np.ndarray]
    false_rate: np.ndarray

    @classmethod
    def build(cls, names: list[str], fallback: str, codes: list[np.ndarray]) -> Filters:
        """``codes`` has the n-grams of each language."""
        bits = max(10, int(np.ceil(np.log2(10 * max(map(len, codes), default=1) + 1))))
        rows = [np.zeros(1 << bits, U) for _ in range(-(-len(names) // 64))]
        rate = np.zeros(len(names))
        for number, found in enumerate(codes):
            word, bit = divmod(number, 64)
            for place in places(found, bits):
                rows[word][place] |= U(1 << bit)
            fill = ((rows[word] >> U(bit)) & U(1)).mean() if len(names) else 0.0
            rate[number] = fill**HASHES
        if len(names) <= 8:  # a byte is enough, and the table stays in cache
            rows = [row.astype(np.uint8) for row in rows]
        return cls(names, fallback, rows, rate)

    def containing(self, code: np.ndarray) -> list[np.ndarray]:
        """Masks of the languages whose filters contain each n-gram."""
        bits = len(self.rows[0]).bit_length() - 1 if self.rows else 0
        at = places(code, bits)
        masks = []
        for row in self.rows:
            mask = row[at[0]]
            for place in at[1:]:
                mask &= row[place]
            masks.append(mask)
        return masks

    def identify(self, part: Texts) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; the score is the language's share of all corrected counts."""
        lettered = _lettered(part)
        code, counts = grams(part)
        total = part.total(counts)
        corrected = np.zeros((len(self.names), len(part)))
        for word, mask in enumerate(self.containing(code)):
            mask = np.where(counts, mask, 0)
            for bit in range(min(64, len(self.names) - 64 * word)):
                number = 64 * word + bit
                hits = part.total((mask >> mask.dtype.type(bit)) & mask.dtype.type(1))
                rate = self.false_rate[number]
                corrected[number] = np.maximum(hits - rate * total, 0) / (1 - rate)
        if not self.names:
            return [UNKNOWN] * len(part), np.zeros(len(part))
        best = corrected.argmax(axis=0)  # the first of equals; names are sorted
        most, whole = corrected.max(axis=0), corrected.sum(axis=0)
        score = np.where(lettered, most / np.maximum(whole, 1e-12), 0.0)
        known = most > 0
        found = [
            UNKNOWN if not has else self.names[i] if sure else self.fallback
            for has, sure, i in zip(lettered.tolist(), known.tolist(), best.tolist())
        ]
        return found, np.where(known, np.clip(score, 0, 1), 0.0)


def places(code: np.ndarray, bits: int) -> list[np.ndarray]:
    """Rows of the table that belong to each n-gram."""
    spread = [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F][:HASHES]
    return [(((code ^ (code >> np.uint32(15))) * np.uint32(m)) >> np.uint32(32 - bits)) for m in spread]


def held_out(key: Column) -> Column:
    """Rows whose language is not learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Filters:
    """Learn the n-grams of each language from a bounded sample of the documents that are not held out."""
    known = docs.select(
        F.col(text).alias("text"), F.col(lang).alias("lang"),
        F.pmod(F.xxhash64(key, F.monotonically_increasing_id()), F.lit(1 << 30)).alias("chance"),
        held_out(F.col(key)).alias("out"),
    ).filter("lang is not null and not out")
    sizes = known.groupBy("lang").agg(F.count("*").alias("docs"))  # one row per language
    sampled = known.join(F.broadcast(sizes), "lang").filter(F.col("chance") * F.col("docs") < SAMPLE * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in slices(batch, "text"):
                code, counts = grams(part)
                names, which = np.unique(np.array(rows.column("lang").to_pylist(), object), return_inverse=True)
                owner = np.repeat(np.arange(len(part)), np.diff(part.bounds))[counts].astype(U)
                pairs = np.unique(owner << U(32) | code[counts])  # each n-gram once a document
                group = which[(pairs >> U(32)).astype(np.int64)].astype(U) << U(32) | (pairs & U(0xFFFFFFFF))
                found, times = np.unique(group, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[(found >> U(32)).astype(np.int64)].tolist(), pa.string()),
                        pa.array((found & U(0xFFFFFFFF)).astype(np.int64)),
                        pa.array(times.astype(np.int64)),
                    ],
                    ["lang", "code", "n"],
                )

    counted = (
        sampled.select("lang", "text").mapInArrow(run, "lang string, code long, n long")
        .groupBy("lang", "code").agg(F.sum("n").alias("n"))
        .join(F.broadcast(sizes), "lang").filter(F.col("n") >= F.least(F.lit(LEAST), F.col("docs")))
        .withColumn("share", F.col("n") / (F.least(F.col("docs"), F.lit(SAMPLE)) + SHRINK))
    )
    most = F.max("share").over(Window.partitionBy("code"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    kept = (
        counted.withColumn("most", most).filter("4 * share >= most")
        .withColumn("place", place).filter(F.col("place") <= KEPT)
        .select("lang", "code").toArrow()  # KEPT rows per language at most
    )
    names, which = np.unique(np.array(kept.column("lang").to_pylist(), object), return_inverse=True)
    codes = kept.column("code").to_numpy().astype(np.uint32)
    order = sizes.orderBy(F.desc("docs"), "lang").limit(1).collect()
    fallback = order[0]["lang"] if order else UNKNOWN
    return Filters.build(names.tolist(), fallback, [np.sort(codes[which == i]) for i in range(len(names))])


def identify(docs: DataFrame, model: Filters, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, held_out, lang_pred and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in slices(batch, text):
                found, sure = model.identify(part)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(key), rows.column("held_out"), pa.array(found, pa.string()), pa.array(sure)],
                    [key, "held_out", "lang_pred", "score"],
                )

    schema = T.StructType([
        docs.schema[key], *T.StructType.fromDDL("held_out boolean, lang_pred string, score double").fields
    ])
    return docs.select(key, text, held_out(F.col(key)).alias("held_out")).mapInArrow(run, schema)
