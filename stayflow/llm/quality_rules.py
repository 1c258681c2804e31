"""Quality rules on lines, in Spark's own expressions.

Lines are normalised (blanks around them off, lower case) and hashed, the
distinct texts of a host that have a line are counted, lines above the limit
are taken out, and a document that loses too much is rejected. Copies of one
text count once, so a document is not rejected for having copies.

Counts per line have a map-side step, and only lines that are over the limit
meet the documents again. A line that a third of all documents share is a row
per document that adaptive execution can split.

Nulls: a null text has no words and fails the word minimum; a null host is a
host of its own. Documents without lines lose nothing. Repeated rows get a row
each. Empty tables give no rows. Extra columns of any name are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import BLANKS
from stayflow.session import materialize
#: Share of a host's documents that a line has to be in, beside the absolute limit: a large host repeats common sentences.
HOST_SHARE = 0.001


def words(text: Column) -> Column:
    """The words between blanks, as an array without empty entries."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def symbol_chars(text: Column) -> Column:
    """Characters of the set #*$%&|<>."""
    return (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("bigint")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")


def normalise_line(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(BLANKS)))


def _text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("text"), text).alias("k2")]


def text_metrics(rows: DataFrame, window: int = 3) -> DataFrame:
    """``rows`` (with ``text``, never null) and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    n_repeat_words counts the words in windows found twice or more. Each window
    is a hash; texts whose hashes all differ are done there. In the others hash
    and place share a long, the place taking the hash's remainder by the number
    of windows, so one sort of plain longs brings equal windows together. What
    is left of the hash has 63 bits less those of the number of windows.
    """
    lines = lines_with_words(F.col("text"))
    rows = rows.withColumn("lines", lines).withColumn("words", words(F.col("text"))).withColumn("n_symbols", symbol_chars(F.col("text")))
    rows = rows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"))
    rows = rows.withColumn("n_words", F.size("words").cast("bigint")).withColumn("word_chars", F.length(F.array_join("words", "")).cast("bigint"))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("lines", "words")
    n = F.greatest(F.col("n_words") - (window - 1), F.lit(0))
    following = lambda h, i: F.xxhash64(h, *[F.get("hashes", i + k) for k in range(1, window)])
    rows = rows.withColumn("windows", F.transform(F.slice("hashes", F.lit(1), n.cast("int")), following)).drop("hashes")
    rows = rows.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows"))
    step = lambda value: F.when(F.col("repeats"), value)
    half = lambda h: F.shiftright(h, 1)
    rows = rows.withColumn("packed", step(F.sort_array(F.transform("windows", lambda h, i: half(h) - F.pmod(half(h), n) + i)))).drop("windows")
    place = lambda x: F.pmod(x, F.greatest(n, F.lit(1)))
    bare = lambda x: x - place(x)
    beside = lambda p, i, k: F.coalesce(bare(F.get("packed", i + k)) == bare(p), F.lit(False))
    found = F.filter("packed", lambda p, i: beside(p, i, -1) | beside(p, i, 1))
    rows = rows.withColumn("places", step(F.sort_array(F.transform(found, place))))
    gap = lambda p, i: F.least(F.coalesce(F.get("places", i + 1) - p, F.lit(window)), F.lit(window)).cast("bigint")
    covered = F.aggregate(F.transform("places", gap), F.lit(0).cast("bigint"), lambda total, g: total + g)
    rows = rows.withColumn("n_repeat_words", F.coalesce(step(covered), F.lit(0).cast("bigint")))
    return rows.drop("repeats", "packed", "places")


def document_lines(documents: DataFrame, host: str = "source") -> DataFrame:
    """(host, k1, k2, doc, place, line_hash, chars): a row per line with a word, in a table of the shared folder.

    ``doc`` stands for the document: its id and text, so a repeated row is the same document.

    The text is read for its lines once; all counting reads this table.
    """
    line = lambda x: F.struct(F.xxhash64(normalise_line(x)).alias("line_hash"), F.length(x).alias("chars"))
    texts = documents.where("text is not null").select(F.col(host).alias("host"), *_text_key(F.col("text")), F.xxhash64("doc_id", "text").alias("doc"), F.transform(lines_with_words(F.col("text")), line).alias("lines"))
    return materialize(texts.select("host", "k1", "k2", "doc", F.posexplode("lines").alias("place", "line")).select("host", "k1", "k2", "doc", "place", "line.*"), "lines")


def frequent_lines(lines: DataFrame, hosts: DataFrame, line_limit: int = 50, host_share: float = HOST_SHARE, of: str = "doc") -> DataFrame:
    """(host, line_hash, found): lines found in more than ``line_limit`` distinct documents of a host, and in more than ``host_share`` of all it has.

    ``hosts`` has host and documents. With ``of="k1"`` distinct texts count
    instead, so that copies of a document do not make its lines frequent.
    """
    found = lines.groupBy("host", "line_hash").agg(F.count_distinct(of).alias("found")).where(F.col("found") > line_limit).alias("f")
    met = found.join(hosts.alias("h"), F.col("f.host").eqNullSafe(F.col("h.host")))
    return met.where(F.col("found") > F.col("documents") * F.lit(host_share)).select("f.*")


def _met(documents: DataFrame, host: str, line_limit: int, host_share: float) -> DataFrame:
    """The lines of ``document_lines`` that are frequent."""
    lines = document_lines(documents, host)
    hosts = documents.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("documents"))
    over = frequent_lines(lines, hosts, line_limit, host_share).alias("o")
    return lines.alias("l").join(over, F.col("l.host").eqNullSafe(F.col("o.host")) & (F.col("l.line_hash") == F.col("o.line_hash"))).select("l.*")


def quality_report(documents: DataFrame, host: str = "source", line_limit: int = 50, host_share: float = HOST_SHARE, least_words: int = 50, repeat_pct: int = 50, kept_pct: int = 50) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_chars, kept.

    ``base_failed``: fewer than ``least_words`` words, or more than
    ``repeat_pct`` percent of them in repeated windows. A document is depleted,
    and not kept, if less than ``kept_pct`` percent of its characters are
    outside frequent lines.
    """
    rows = documents.select("doc_id", F.col(host).alias("host"), *_text_key(F.col("text")), F.coalesce("text", F.lit("")).alias("text"))
    rows = text_metrics(rows.withColumn("n_chars", F.length("text").cast("bigint"))).drop("text")
    # copies of a text bring each line once
    once = _met(documents, host, line_limit, host_share).groupBy("host", "k1", "k2", "place").agg(F.first("chars").alias("chars"))
    lost = once.groupBy("host", "k1", "k2").agg(F.sum("chars").alias("lost")).alias("l")
    same = F.col("d.host").eqNullSafe(F.col("l.host")) & (F.col("d.k1") == F.col("l.k1")) & (F.col("d.k2") == F.col("l.k2"))
    rows = rows.alias("d").join(lost, same, "left").select("d.*", F.coalesce("lost", F.lit(0)).cast("bigint").alias("lost_chars"))
    failed = (F.col("n_words") < least_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(repeat_pct) * F.col("n_words"))
    depleted = F.lit(100) * F.col("lost_chars") > F.lit(100 - kept_pct) * F.col("n_chars")
    rows = rows.withColumn("base_failed", failed)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_chars", (~F.col("base_failed") & ~depleted).alias("kept"))


def remove_frequent_lines(documents: DataFrame, host: str = "source", line_limit: int = 50, host_share: float = HOST_SHARE) -> DataFrame:
    """The documents without their frequent lines; all else in ``text`` stays as it is.

    Frequent lines come as one array per text, so a text is never cut into rows.
    """
    gone = _met(documents, host, line_limit, host_share).groupBy("host", "k1", "k2").agg(F.collect_set("line_hash").alias("hashes"))
    k1, k2 = _text_key(F.col("d.text"))
    same = F.col(f"d.{host}").eqNullSafe(F.col("g.host")) & (k1 == F.col("g.k1")) & (k2 == F.col("g.k2"))
    keep = F.filter(F.split("d.text", "\n"), lambda line: ~F.array_contains("g.hashes", F.xxhash64(normalise_line(line))))
    text = F.when(F.col("g.hashes").isNull(), F.col("d.text")).otherwise(F.array_join(keep, "\n"))
    return documents.alias("d").join(gone.alias("g"), same, "left").select(*[text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in documents.columns])
