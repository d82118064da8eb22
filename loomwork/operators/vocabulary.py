"""The ``words`` tokenizer: pieces between ASCII white space, with a vocabulary counted from a corpus."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.text import col
from loomwork.functions.tokenizers import PandasTokenizer, Tokenizer
from loomwork.operators.numbering import number_rows

UNKNOWN_ID = 0
# The one definition of a word border, for Column functions and for Python alike.
BORDER = r"[ \t\n\x0B\f\r]+"
# The most frequent pieces, if short, are looked up in a broadcast table: at most FREQUENT x (FREQUENT_BYTES + 8) bytes.
# None of the others can make a hot key.
FREQUENT, FREQUENT_BYTES = 4096, 64
# A dictionary up to this size may live in every Python worker.
LOCAL_PIECES, LOCAL_BYTES = 200_000, 16 << 20


def pieces(text: Column | str) -> Column:
    return F.filter(F.split(col(text), BORDER), lambda w: w != "")


def split_words(text: str) -> list[str]:
    """The same pieces in Python: bytes split at ASCII white space, and only there."""
    return [w.decode() for w in text.encode().split()]


def build_vocabulary(df: DataFrame, columns: list[str], size: int | None = None) -> DataFrame:
    """``(piece, id, n)``: all pieces, or the ``size`` most frequent; ids from 1 by count, then by piece.

    Counts combine on the map side, so a word that fills the corpus costs one row per task. Ids are places in
    a total order over range partitions; the numbered table is written down.
    """
    words = df.select(F.explode(F.concat(*(F.coalesce(pieces(c), F.array().cast("array<string>")) for c in columns)))
                      .alias("piece"))
    counted = words.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    numbered = number_rows(counted, [F.col("n").desc(), F.col("piece").asc()], "id").select("piece", F.col("id").cast("bigint"), "n")
    return numbered if size is None else numbered.filter(F.col("id") <= size)


# ---------------------------------------------------------------- ids by join

def _with_ids(rows: DataFrame, keys: list[str], vocabulary: DataFrame) -> DataFrame:
    """Rows ``(keys, _pos, _piece, ...)`` with ``_id`` in place of ``_piece``. A piece that begins with a blank, which no word does, is a
    number as it is.

    The dictionary is joined, never held: its most frequent pieces as a broadcast table of bounded size, all others by a shuffle.
    Rows that need none of the others go through that under names no piece has, one name per text: side by side they take little room,
    and one task makes them a single row of the text again.
    """
    rest = [c for c in rows.columns if c != "_piece"]
    often = (F.col("id") <= FREQUENT) & (F.octet_length("piece") <= FREQUENT_BYTES)
    first = vocabulary.filter(often).select(F.col("piece").alias("_often"), F.col("id").alias("_of_often"))
    others = vocabulary.filter(~often).select(F.col("piece").alias("_other"), F.col("id").alias("_of_other"))
    number = F.when(F.startswith("_piece", F.lit(" ")), F.substr("_piece", F.lit(2)).cast("bigint"))
    known = rows.join(F.broadcast(first), F.col("_piece") == F.col("_often"), "left").withColumn("_id", F.coalesce("_of_often", number))
    spread = F.concat(F.lit(" "), F.pmod(F.xxhash64(*keys), F.lit(1 << 16)))
    wanted = F.when(F.col("_id").isNull() & F.col("_piece").isNotNull(), F.col("_piece")).otherwise(spread)
    return known.select(*rest, "_id", wanted.alias("_wanted")).join(others, F.col("_wanted") == F.col("_other"), "left").select(
        *rest, F.coalesce("_id", "_of_other", F.lit(UNKNOWN_ID)).alias("_id"))


def _in_order(*fields: str | Column) -> Column:
    """The rows of a group by position; rows of texts without a piece have none."""
    row = F.struct("_pos", *fields)
    return F.sort_array(F.collect_list(F.when(F.col("_pos").isNotNull(), row)))


def encode_words(df: DataFrame, key: str, text: str, vocabulary: DataFrame) -> DataFrame:
    """``(key, ids)``: pieces looked up in the vocabulary, unknown ones as 0, in text order. ``key`` must be unique."""
    rows = df.select(key, F.posexplode_outer(pieces(text)).alias("_pos", "_piece"))
    found = _with_ids(rows, [key], vocabulary).groupBy(key).agg(_in_order("_id").alias("_rows"))
    return found.select(key, F.transform("_rows", lambda r: r["_id"]).alias("ids"))


@dataclass(frozen=True)
class PieceTokenizer(Tokenizer):
    """Pieces stand for their ids until ``look_up``; numbers of special tokens and masks are texts that begin with a blank."""

    def constant(self, ids: list[int]) -> Column:
        return F.array(*map(self.one, ids)) if ids else F.array().cast("array<string>")

    def one(self, i: int) -> Column:
        return F.lit(f" {i}")

    def literal(self, text: str) -> Column:
        words = split_words(text)
        return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")

    def encode(self, text: Column) -> Column:
        return pieces(text)


def look_up(encoded: DataFrame, keys: list[str], vocabulary: DataFrame) -> DataFrame:
    """Examples of a ``PieceTokenizer`` with real ids. ``keys`` name an example; the cutoff bounds the rows it comes to.

    Only pieces that are left after the cut are looked up. A label is a number or the id at its position.
    """
    both = F.transform(F.col("input_ids"), lambda p, i: F.struct(p.alias("piece"), F.get("labels", i).alias("label")))
    rows = encoded.select(*keys, F.posexplode_outer(both).alias("_pos", "_both"))
    label = F.when(F.startswith("_both.label", F.lit(" ")), F.substr("_both.label", F.lit(2)).cast("bigint"))
    rows = rows.select(*keys, "_pos", F.col("_both.piece").alias("_piece"), label.alias("_label"))
    found = _with_ids(rows, keys, vocabulary).groupBy(*keys).agg(_in_order("_id", F.coalesce("_label", "_id").alias("_label")).alias("_rows"))
    return found.select(
        *keys, F.transform("_rows", lambda r: r["_id"].cast("int")).alias("input_ids"),
        F.transform("_rows", lambda r: r["_label"].cast("int")).alias("labels")).withColumn(
        "attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))


def encode_examples(encode: Callable[[Tokenizer], DataFrame], keys: list[str], vocabulary: DataFrame, **settings) -> DataFrame:
    """``encode(tokenizer)`` with the ids of a vocabulary of any size, which no worker and no driver holds.

    ``encode`` calls ``encode_sft`` or ``encode_conversations`` and keeps ``keys``. Special tokens follow the vocabulary.
    """
    base = (vocabulary.agg(F.max("id")).first()[0] or 0) + 1
    return look_up(encode(PieceTokenizer(base=base, **settings)), keys, vocabulary)


# ---------------------------------------------------------------- ids by dictionary

def words_tokenizer(spark: SparkSession, vocabulary: DataFrame, max_pieces: int = LOCAL_PIECES, max_bytes: int = LOCAL_BYTES,
                    **settings) -> PandasTokenizer:
    """A small vocabulary as a tokenizer that also decodes; special tokens follow the vocabulary.

    Its table lives in every Python worker, so pieces and bytes are counted before any reach the driver; larger ones are
    for ``encode_examples``.
    """
    n, size = vocabulary.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("piece")), F.lit(0))).first()
    if n > max_pieces or size > max_bytes:
        raise ValueError(f"{n} pieces of {size} bytes do not fit a worker; use encode_examples")
    ids = {r["piece"]: r["id"] for r in vocabulary.select("piece", "id").collect()}
    shared = spark.sparkContext.broadcast(ids)

    def load():
        known = shared.value
        names = {i: piece for piece, i in known.items()}

        def encode(texts):
            return [[known.get(w, UNKNOWN_ID) for w in split_words(text)] for text in texts]

        def decode(rows):
            return [" ".join(names.get(i, "") for i in row) for row in rows]
        return encode, decode
    return PandasTokenizer(base=max(ids.values(), default=0) + 1, load=load, **settings)
