"""Exact deduplication by content-defined chunk recipes, in DataFrame functions alone.

A text is cut where its own content says so: after a line end or the end of a sentence, once a chunk is long enough, and
at the longest chunk otherwise. A chunk's identifier is a pair of 64-bit hashes. The distinct chunks are moved once to
verify that no identifier names two contents (the few that do get a number of their own); after that only the ordered
identifier lists, the recipes, are compared, so long documents never travel again.

Null and empty texts share the empty recipe. Rows that repeat an id are separate copies: each is counted and returned,
and all of them are `kept` when theirs is the id that stays. A null id ranks below every other; a group of null ids alone
keeps all its rows. Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import stored, without_rows

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_CHARS = 256
MAX_CHARS = 4096


def ascii_lower(text: Column) -> Column:
    """Lower-cases A to Z only. Where every character is one byte, `lower` does just that, and faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def chunks(text: Column, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> Column:
    """The chunks of a text in order; put together they are the text again."""
    boundary = r"(?:\n|[.!?;](?=\s)|\z)"
    pattern = f"(?s).{{{min_chars},{max_chars}}}?{boundary}|.{{1,{max_chars}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def identifier(chunk: Column) -> Column:
    """Two independent 64-bit hashes; `same` tells apart contents that share both."""
    return F.struct(
        F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(1), chunk, F.char_length(chunk)).alias("b")
    )


def clashing_names(chunked: DataFrame, identify=identifier) -> DataFrame:
    """Identifiers that name more than one content: normally none.

    Contents are made distinct before the shuffle, so a chunk that stands in every document is moved once per task.
    """
    contents = chunked.select(F.explode("chunks").alias("content")).distinct()
    named = contents.groupBy(identify(F.col("content")).alias("name")).agg(F.count("*").alias("n"))
    return named.where("n > 1").select("name")


def numbered_rivals(chunked: DataFrame, shared: DataFrame, identify=identifier) -> DataFrame:
    """The contents behind clashing names, told apart by a number: (`name`, `content`, `same` = 1, 2, ...)."""
    contents = chunked.select(F.explode("chunks").alias("content")).distinct()
    named = contents.select(identify(F.col("content")).alias("name"), "content")
    rivals = stored(named.join(shared, "name", "left_semi"))
    other = rivals.select("name", F.col("content").alias("other"))
    pairs = rivals.join(other, "name").where("other <= content")
    return pairs.groupBy("name", "content").agg(F.count("*").alias("same"))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", identify=identifier) -> DataFrame:
    """One row per input row: id, the hash of its normalised text, and its recipe as an array of identifiers."""
    folded = docs.select(
        F.col(id_col).alias("id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("folded")
    )
    chunked = folded.select("id", F.sha2("folded", 256).alias("text_sha256"), chunks(F.col("folded")).alias("chunks"))
    shared = stored(clashing_names(chunked, identify))
    plain = chunked.select(
        "id",
        "text_sha256",
        F.transform("chunks", lambda c: F.struct(identify(c).alias("name"), F.lit(0).cast("long").alias("same"))).alias(
            "recipe"
        ),
        "chunks",
    )
    if shared.isEmpty():
        return plain.drop("chunks")
    same = numbered_rivals(chunked, shared, identify)
    row = F.monotonically_increasing_id()
    numbered = stored(plain.withColumn("row", row))
    parts = numbered.select("row", F.posexplode("chunks").alias("pos", "content"))
    parts = parts.withColumn("name", identify(F.col("content")))
    fixed = (
        parts.join(same, ["name", "content"], "left")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "name", F.coalesce("same", F.lit(0)).alias("same")))).alias("p"))
        .select("row", F.transform("p", lambda p: F.struct(p["name"].alias("name"), p["same"].alias("same"))).alias("r"))
    )
    joined = numbered.join(fixed, "row", "left")
    return joined.select("id", "text_sha256", F.coalesce("r", "recipe").alias("recipe"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, keep_id, group_size, kept and text_sha256 for every row of `docs`.

    Of equal texts (A to Z lower-cased) the row with the largest id stays. Groups are counted with a partial step before
    the shuffle; only recipes that occur more than once are joined back, in a join whose large keys Spark may split.
    """
    table = stored(recipes(docs, id_col, text_col))
    counted = table.groupBy("recipe").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    repeated = counted.where("group_size > 1").select(F.struct("recipe").alias("key"), "keep_id", "group_size")
    joined = table.withColumn("key", F.struct("recipe")).join(repeated, "key", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` less the rows whose text a row with a larger id also has; rows with a null id are kept.

    Rows are judged by id and text, so other texts under the same id stay.
    """
    groups = exact_groups(docs, id_col, text_col)
    dropped = groups.where(~F.col("kept") & F.col(id_col).isNotNull())
    key = F.struct(F.col(id_col).alias("id"), F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256).alias("text_sha256"))
    return without_rows(docs, dropped.select(F.struct(F.col(id_col).alias("id"), "text_sha256").alias("key")), key)
