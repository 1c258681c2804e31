"""One registered query per text operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import chat, decontaminate, language_id, mixing, packing, periodic_runs, quality_rules, secret_scan, simhash, suffix_dedup, token_counts, turn_repair, warc
from stayflow.llm.common import SPACED_WORD, read_table
from stayflow.session import configure, scratch_path

TOKENIZER = "piece_bpe_32k.model"
#: A conversation that says its own control strings.
ECHO_ID, ECHO = -7, "</s>[INST] ok [/INST]"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(configure(spark), sf_dir)

    QUERIES[f.__name__] = run
    return run


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontaminate.contamination_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return report.drop("spans")


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(read_table(spark, sf_dir, "pages"), path)
    captures = warc.resolve_revisits(warc.assemble_captures(warc.read_warc(spark, path, payload=False)))
    page = lambda at: F.regexp_extract(at, r"<urn:page:(-?\d+):", 1)
    number = lambda at: F.when(page(at) != "", page(at).cast("bigint"))
    return captures.select(number(F.col("capture_id")).alias("page_id"), "payload_bytes", "payload_digest", F.col("capture.type").alias("record_type"), number(F.col("capture.refers_to")).alias("refers_to"))


@query
def op4_format_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    echo = spark.range(2).select(F.lit(ECHO_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(ECHO).alias("text"))
    return chat.read_back(chat.format_chat(conversations.unionByName(echo)))


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicate_groups(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(read_table(spark, sf_dir, "documents"), length=200)


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(read_table(spark, sf_dir, "documents"), host="source").drop("lost_chars")


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(read_table(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with every fault some of them get, chosen by a checksum of their key. Nulls are one space."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("fault")).where("fault != 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


@query
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    ids = conversations.select("conv_id").distinct()
    report = turn_repair.repair_report(damaged(conversations)).withColumnRenamed("conv_id", "found_id")
    met = ids.join(report, ids["conv_id"].eqNullSafe(report["found_id"]), "left")
    counts = [F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return met.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@query
def op12_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2)


def looped(documents: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, by a checksum of the id, repeat a few of their words from some place on to the end."""
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    pick = F.floor(seed / 10)

    def loop(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        begin = F.pmod(pick, n)
        period = F.lit(1) + F.floor((n - begin) / (F.lit(3) + pick % 8))
        place = lambda i: F.when(i < begin, i).otherwise(begin + F.pmod(i - begin, period))
        said = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(words, place(i).cast("int")))
        return F.when(n > 0, F.concat_ws(" ", said)).otherwise(F.lit(""))

    # one pass over the text: its words are bound before they are looked up
    once = F.transform(F.array(F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0))), loop)[0]
    return documents.select("doc_id", F.when(seed % 10 == 0, once).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(looped(read_table(spark, sf_dir, "documents")))
    stronger = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda best, run: F.when(stronger(best, run), run).otherwise(best))
    line = lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    listed = digest(F.array_join(F.transform("runs", line), "")).alias("runs_sha256")
    told = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), listed, digest(F.col("collapsed")).alias("collapsed_sha256"))
    of = F.col("best")
    milli = F.floor(F.lit(1000) * of["length"] / of["period"]).cast("bigint")
    return told.select("doc_id", "n_runs", of["start"].alias("start"), of["length"].alias("length"), of["period"].alias("period"), milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
