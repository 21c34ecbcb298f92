"""Repeated lines leave documents, known by range-partitioned hashes; what comes back are bitmaps, not texts.

Every line becomes a narrow row: a 128-bit hash of its key, a 128-bit hash of its document and its position. The rows are
ranged by hash, then document, and sorted by position, so a line that stands in a third of all documents spreads over many
partitions, also when its lines are looked up again. In that order one running pass marks the first occurrence of a key in each document, and documents per key are
sums of these marks, combined before they are shuffled. Lines of keys found in ``min_documents`` documents are dropped
everywhere, or with ``keep_first`` everywhere but at their very first occurrence. Their positions come back as sparse
bitmaps: for every 64 lines of a document one word of bits, words without a bit left out.

A key is the line without the blanks around it, with A-Z lower-cased; empty keys are never dropped. All of it is DataFrame
functions. Two different keys, or documents, fall together with a chance of 2^-128 a pair.

Rules for odd input: a null or empty text is one empty line and stays; every row is a document of its own when documents
are counted, also rows that repeat a key column or everything; rows with equal id and text get equal bitmaps (with
``keep_first`` all of them keep the first occurrence); a null id comes first in the order; an empty table gives an
empty result; other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.operators.staging import remove, stage

MIN_DOCUMENTS = 10
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS = 64


def lines(text: str | Column) -> Column:
    """The lines of a text, at least one."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(text: str | Column) -> Column:
    """The key of every line."""
    trimmed = F.transform(lines(text), lambda line: F.btrim(line, F.lit(BLANKS)))
    # Lower-casing is quick on plain ASCII; elsewhere only A-Z may change.
    plain = lambda line: F.octet_length(line) == F.char_length(line)
    return F.transform(trimmed, lambda line: F.when(plain(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER)))


def _hashes(first: str, second: str, *of: str) -> list[Column]:
    return [F.xxhash64(*of).alias(first), F.xxhash64(F.lit(11), *of).alias(second)]


def _wrapped(df: DataFrame, key: str, text: str) -> DataFrame:
    """Id, text and identity of the documents, and their other columns as one column ``_rest``, so that no names clash."""
    rest = [F.col(f"`{name}`") for name in df.columns if name not in (key, text)]
    docs = df.select(
        F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text"),
        F.struct(*rest).alias("_rest") if rest else F.lit(None).alias("_rest"),
    )
    return docs.select("*", *_hashes("_a", "_b", "_id", "_text"))


def occurrences(docs: DataFrame) -> DataFrame:
    """One row per line with a key: its hash, document, position and range, and whether it is the document's first."""
    numbered = docs.select("_id", "_a", "_b", "_text", F.monotonically_increasing_id().alias("_row"))
    keyed = F.transform(line_keys("_text"), lambda line, i: F.struct(i.alias("_position"), line.alias("_key")))
    rows = numbered.select("_id", "_a", "_b", "_row", F.inline(keyed)).filter("_key <> ''")
    rows = rows.select(*_hashes("_h", "_g", "_key"), "_id", "_a", "_b", "_row", "_position")
    document = ["_h", "_g", "_id", "_a", "_b", "_row"]
    # Ranges never cut a document's run of one key, which is at most the lines of one document.
    ranged = rows.repartitionByRange(*document).sortWithinPartitions(*document, "_position")
    place = F.row_number().over(Window.partitionBy(*document).orderBy("_position"))
    return ranged.withColumns({"_first": (place == 1).cast("long"), "_range": F.spark_partition_id()}).drop("_row")


def drop_bitmaps(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_documents: int = MIN_DOCUMENTS, keep_first: bool = False
) -> DataFrame:
    """Rows (_a, _b, _words) for the documents that lose lines, known by their identity hashes.

    ``_words`` is an array of (word, bits): bit i of word w stands for line 64 * w + i.
    """
    return _bitmaps(_wrapped(df, key, text), min_documents, keep_first)


def _bitmaps(docs: DataFrame, min_documents: int, keep_first: bool) -> DataFrame:
    found = stage(occurrences(docs))
    per_key = found.groupBy("_h", "_g").agg(
        F.sum("_first").alias("_documents"), F.min("_range").alias("_low"), F.max("_range").alias("_high"),
        F.min(F.struct("_id", "_a", "_b", "_position")).alias("_earliest"),
    )
    frequent = per_key.filter(F.col("_documents") >= min_documents)
    # A key fills neighbouring ranges, so with the range as a join key a hot one meets its lines range by range.
    spread = frequent.select("_h", "_g", "_earliest", F.explode(F.sequence("_low", "_high")).alias("_range"))
    # As many keys as there are frequent lines, so never broadcast.
    repeated = found.join(spread.hint("merge"), ["_h", "_g", "_range"])
    if keep_first:
        repeated = repeated.filter(F.struct("_id", "_a", "_b", "_position") != F.col("_earliest"))
    word = F.floor(F.col("_position") / BITS).cast("int").alias("_word")
    bit = F.expr(f"shiftleft(1L, _position % {BITS})")
    words = repeated.groupBy("_a", "_b", word).agg(F.bit_or(bit).alias("_bits"))
    maps = words.groupBy("_a", "_b").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_word").alias("word"), F.col("_bits").alias("bits")))).alias("_words")
    )
    staged = stage(maps)
    remove(found)
    return staged


def dropped_positions(words: str | Column) -> Column:
    """The line numbers, from 0, whose bits are set; of null none."""

    def of(word: Column) -> Column:
        places = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: word["word"] * BITS + i)
        return F.filter(places, lambda place: F.getbit(word["bits"], place % BITS) == 1)

    return F.coalesce(F.flatten(F.transform(words, of)), F.array().cast("array<int>"))


def _marked(df: DataFrame, key: str, text: str, min_documents: int, keep_first: bool) -> DataFrame:
    docs = _wrapped(df, key, text)
    found = _bitmaps(docs, min_documents, keep_first)
    # As many bitmaps as there are documents in the worst case, so never broadcast.
    return docs.join(found.hint("merge"), ["_a", "_b"], "left").withColumn("_dropped", dropped_positions("_words"))


def keep_bitmaps(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_documents: int = MIN_DOCUMENTS, keep_first: bool = False
) -> DataFrame:
    """One row per row of ``df``: id, n_lines, n_dropped and the sparse bitmap of the lines it loses (null: none)."""
    return _marked(df, key, text, min_documents, keep_first).select(
        F.col("_id").alias(key), F.size(lines("_text")).cast("long").alias("n_lines"),
        F.size("_dropped").cast("long").alias("n_dropped"), F.col("_words").alias("dropped"),
    )


def _cut(df: DataFrame, key: str, text: str, min_documents: int, keep_first: bool) -> DataFrame:
    marked = _marked(df, key, text, min_documents, keep_first)
    split = marked.select("_id", "_text", "_rest", "_dropped", lines("_text").alias("_lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    kept = F.array_join(F.transform(places, lambda i: F.get(F.col("_lines"), i)), "\n")
    return split.select(
        "_id", "_text", "_rest", F.size("_lines").cast("long").alias("_n_lines"),
        F.size("_dropped").cast("long").alias("_n_dropped"),
        F.when(F.size("_dropped") == 0, F.coalesce("_text", F.lit(""))).otherwise(kept).alias("_kept"),
    )


def without_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_documents: int = MIN_DOCUMENTS, keep_first: bool = False
) -> DataFrame:
    """The rows of ``df`` with all their columns, repeated lines cut out of the text; a null text stays null."""
    cut = _cut(df, key, text, min_documents, keep_first)
    own = {key: F.col("_id"), text: F.when(F.col("_text").isNotNull(), F.col("_kept"))}
    return cut.select(*[own.get(name, F.col(f"_rest.`{name}`")).alias(name) for name in df.columns])


def digest(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: id, counts of lines and the SHA-256 of the text that stays."""
    return _cut(df.select(f"`{key}`", f"`{text}`"), key, text, MIN_DOCUMENTS, False).select(
        F.col("_id").alias(key), F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )
