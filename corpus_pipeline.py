"""Corpus pipeline: language ID, near-duplicate removal, benchmark decontamination, secret redaction, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.llm import decontaminate, language, mixing, secrets, simhash
from barwright.llm.common import fold, stored, table, unused

#: A text goes if no language reaches this probability.
LEAST_LANGUAGE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter (null and empty ones too) and texts of no known language; a missing language is filled in.

    Rows that repeat, and rows with null or repeated ids, are judged each by its text. All columns, whatever their names, stay as they are
    but lang. An empty table stays empty; where no row has a language, all texts with a letter stay.
    """
    model = language.train(docs.where(F.coalesce(fold(F.col("doc_id"), 4) != 2, F.lit(True))))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))  # so that no column of docs meets those of the model
    if not model.langs:
        return whole.where(F.col("doc.text").rlike(r"\p{L}")).select("doc.*")
    found = language.identified(whole, model, "doc.text").where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE))
    return found.withColumn("doc", F.col("doc").withField("lang", F.coalesce("doc.lang", "lang_pred"))).select("doc.*")


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a stored key for each row, as ids may be null or repeated, and the key's name, which no column of docs has."""
    key = unused(docs, "_row")
    return stored(docs.withColumn(key, F.monotonically_increasing_id()), compression="zstd"), key


def with_digest(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with the MD5 digest of the text, by which rows alike in it are found again, and its name. It is null where the text is."""
    key = unused(docs, "_digest")
    return docs.withColumn(key, F.md5(F.col("text").cast("binary"))), key


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every near-duplicate group: that with the smallest id, null ids last, of rows with that id the first.

    Rows without an id and rows that repeat an id are documents of their own, which only go as near duplicates. Null and empty texts are one
    group. All columns stay as they are, and an empty table stays empty.
    """
    rows, key = keyed(docs)
    groups = simhash.near_duplicates(rows.select(key, "text"), key).join(rows.select(key, "doc_id"), key)
    groups = stored(groups.select("component_id", "doc_id", key))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", key))
    several = groups.groupBy("component_id").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1").select("component_id", F.col(f"first.{key}").alias("kept"))
    gone = stored(groups.join(several, "component_id").where(F.col(key) != F.col("kept")).select(key))  # fewer than those that stay
    return rows.join(gone, key, "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; null and empty texts, and rows with null or repeated ids that hold none, stay.

    All columns stay as they are. Without items, or rows, nothing goes. Equal texts hold the same items, so a digest of the text tells rows apart.
    """
    rows, key = with_digest(docs)
    found = decontaminate.leaks(rows.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    found = stored(found.select(F.col("doc_id").alias(key)).distinct())
    return rows.join(found, key, "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; every row stays, n_chars follows its text, and all other columns stay as they are.

    Null texts stay null with null n_chars; repeated rows are redacted alike; an empty table stays empty. Rows of one text and source hold
    the same secrets, so a hash of both tells rows apart; should two hashes meet, a value is only replaced where a text holds it.
    """
    key = unused(docs, "_hash")
    rows = docs.withColumn(key, F.xxhash64("text", "source"))
    found = stored(secrets.secrets(rows.select(key, "text", "source"), id_col=key).select(key, "value").distinct())
    return secrets.redacted(rows, found, key).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Makes and writes the mix; how many words of each remaining document it takes.

    Null and empty texts have size 0; rows with null or repeated ids are documents of their own; other columns are ignored; an empty table
    gives no row.
    """
    return mixing.mixed(docs.select("doc_id", "text", "source"))


STAGES = [(f.__name__, f) for f in (language_id, simhash_near_dedup, benchmark_decontamination, secret_scan, source_mix)]

#: SQL can express none of the trained stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after all stages before the mix, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


def mixed_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed corpus itself: rows (shard, slot, sid, block, parts, words)."""
    return mixing.mix(cleaned(spark, sf_dir).select("doc_id", "text", "source"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents."""
    return STAGES[-1][1](spark, cleaned(spark, sf_dir), sf_dir)
