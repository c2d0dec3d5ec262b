"""Secret scans: candidate strings judged by a random forest, with DataFrame and ML functions of the JVM only."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, unused

#: Shortest candidate, shortest one that a credential's name precedes, and as how many findings the two labels weigh at most.
MIN_LENGTH, NAMED_LENGTH, MAX_LABELLED = 12, 6, 20_000
#: Words of the dictionary that come from the corpus at most, and how often one has to occur.
DICTIONARY_SIZE, LEAST_COUNT = 20_000, 5
#: Trees, their depth, least share of votes for a secret.
TREES, DEPTH, LEAST = 24, 7, 0.5
REDACTED = "[REDACTED]"
#: Words that name credentials, and everyday words of addresses, examples and file names.
KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "auth", "bearer", "credential", "private_key")
DICTIONARY = (
    "about", "account", "address", "archive", "article", "branch", "build", "change", "class", "client", "com", "commit", "config", "content", "data",
    "default", "demo", "docs", "domain", "dummy", "example", "file", "format", "function", "github", "group", "hash", "home", "html", "http", "https",
    "image", "index", "info", "item", "license", "link", "list", "local", "localhost", "mail", "main", "master", "mock", "model", "name", "net",
    "null", "number", "object", "org", "package", "page", "path", "placeholder", "print", "product", "public", "release", "report", "return",
    "sample", "schema", "script", "server", "service", "session", "source", "sha", "static", "string", "system", "table", "test", "title", "type",
    "update", "user", "value", "version", "web", "www", "xxxx", "your",
)
#: Forms that name their issuer or their use, and forms of things that are no secrets. They label findings for the fit only.
CERTAIN_SECRET = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}|AIza[0-9A-Za-z_-]{35})$"
CERTAIN_OTHER = r"^([^@]+@[^@]+\.[a-z]+|https?://.*|[0-9.:/+()-]+|[0-9]{4}-[0-9]{2}-[0-9]{2}.*|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|[a-z]+([._/-][a-z]+)*[0-9]{0,4}|[A-Z]+|[^\x00-\x7f]+.*)$"
STAND_IN = r"example|changeme|placeholder|your|xxx|\*\*\*|^<|\$\{"
ASSIGNED_HEX = r"^[0-9a-fA-F]{16,}$"
FEATURES = (
    "length", "transitions", "digit_share", "upper_share", "hex_share", "distinct_share", "symbol_share", "coverage", "key_before", "key_inside", "assigned", "quoted",
    "path_depth", "path_test", "previous_length", "next_length",
)


def frequent_words(docs: DataFrame, text: str = "text", most: int = DICTIONARY_SIZE) -> DataFrame:
    """Rows (word): the most frequent words of three letters or more of all texts, lower-cased, `most` at most, and DICTIONARY. Stored."""
    words = docs.select(F.explode(F.split(F.lower(text), r"\P{L}+")).alias("word")).where(F.length("word") >= 3)
    top = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "word").limit(most).select("word")
    fixed = docs.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, DICTIONARY))).alias("word"))
    return stored(top.union(fixed).distinct())


def candidates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Rows (id, path, place, word, value, previous, next, key, quoted): words of MIN_LENGTH or more characters with a digit, or of 16
    capitals, and all words of NAMED_LENGTH or more that a credential's name precedes, in an assignment or as one of the two words before.

    place is the word's position in the text; value is the word without quotes and closing punctuation and, in an assignment, without
    its key. previous holds the two words before. Neighbours are taken before the words of a text become rows, so the work is linear.
    """
    w, keyword = F.col("words"), "(" + "|".join(KEYWORDS) + ")"
    source = docs.select(F.col(id_col).alias("id"), F.col(path).alias("path"), F.col(text).alias("text")).where(F.col("text").rlike(rf"[!-~]{{{MIN_LENGTH},}}") | F.lower("text").rlike(keyword))
    words = source.select("id", "path", F.split("text", r"[\x20\x09-\x0D]+").alias("words"), F.lower("text").rlike(keyword).alias("named"))
    get = lambda i: F.coalesce(F.get(w, i), F.lit(""))
    before = lambda i: F.lower(F.concat_ws(" ", get(i - 2), get(i - 1)))

    def chosen(i: Column) -> Column:
        x = get(i)
        named = F.col("named") & (F.length(x) >= NAMED_LENGTH) & (F.lower(x).rlike(f"{keyword}[^=:]{{0,20}}[=:].{{{NAMED_LENGTH}}}") | before(i).rlike(keyword))
        return ((F.length(x) >= MIN_LENGTH) & x.rlike(r"[0-9]|^[\"'(]*[A-Z]{16}")) | named

    places = F.filter(F.sequence(F.lit(0), F.size(w) - 1), chosen)
    struct = lambda i: F.struct(i.alias("place"), get(i).alias("word"), before(i).alias("previous"), F.lower(get(i + 1)).alias("next"))
    hits = words.select("id", "path", F.explode(F.transform(places, struct)).alias("s")).select("id", "path", "s.*")
    raw = F.col("word")
    value = F.regexp_replace(F.regexp_replace(raw, r"^[^=:]{0,40}(=|:(?!//))(?=[^=/])", ""), r"^[\"'`(<\[]+|[\"'`)>\],.;:!?*&%$#]+$", "")
    key = F.lower(F.regexp_extract(raw, r"^([^=:]{0,40})(=|:(?!//))(?=[^=/])", 1))
    out = hits.withColumns({"value": value, "key": key, "quoted": raw.rlike("[\"'`]")})
    named = F.col("key").rlike(keyword) | F.col("previous").rlike(keyword)
    return out.where((F.length("value") >= MIN_LENGTH) | ((F.length("value") >= NAMED_LENGTH) & named))


def covered(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Adds coverage, the share of a value's characters in words of the dictionary; a value's words are its runs of letters, cut at capitals."""
    runs = F.array_distinct(F.regexp_extract_all(F.regexp_replace("value", r"(?<=\p{Ll})(?=\p{Lu})", " "), F.lit(r"\p{L}{3,}"), F.lit(0)))
    rows = found.select("value").distinct().select("value", F.explode(runs).alias("run")).withColumn("word", F.lower("run"))
    known = rows.join(F.broadcast(dictionary), "word")  # DICTIONARY_SIZE words at most
    times = lambda v, run: (F.length(v) - F.length(F.replace(v, run, F.lit("")))).cast("long")
    share = known.groupBy("value").agg(F.least(F.sum(times(F.col("value"), F.col("run"))) / F.length("value"), F.lit(1.0)).alias("coverage"))
    return found.join(share, "value", "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))


def featured(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Adds the numbers that the forest sees: length, character transitions, dictionary coverage, path and neighbouring words."""
    v, n = F.col("value"), F.length("value")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    keyword = "(" + "|".join(KEYWORDS) + ")"
    path = F.lower(F.coalesce("path", F.lit("")))
    number: dict[str, Column] = {
        "length": n,
        "transitions": F.regexp_count(v, F.lit(r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])")) / n,
        "digit_share": share("[0-9]"),
        "upper_share": share("[A-Z]"),
        "hex_share": share("[0-9a-f]"),
        "distinct_share": F.size(F.array_distinct(F.split(v, ""))) / n,
        "symbol_share": share("[^A-Za-z0-9]"),
        "key_before": F.col("previous").rlike(keyword),
        "key_inside": F.col("key").rlike(keyword),
        "assigned": F.col("previous").rlike("[=:]$") | (F.length("key") > 0),
        "quoted": F.col("quoted"),
        "path_depth": F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))),
        "path_test": path.rlike("test|example|sample|mock|fixture|doc"),
        "previous_length": F.length("previous"),
        "next_length": F.length("next"),
    }
    return covered(found, dictionary).withColumns({k: c.cast("double") for k, c in number.items()})


def labelled(found: DataFrame) -> DataFrame:
    """Findings with a label (1 secret, 0 not) by their form alone, where that is beyond doubt; for use where no reviewed findings exist.

    A value in an issuer's format, a hexadecimal one that a credential's name is assigned, and one of eight characters of several kinds that
    a credential's name in the same word is assigned, are secrets. Stand-ins, and without a credential's name addresses, numbers, dates,
    UUIDs, plain words and hexadecimal values are not.
    """
    keyword = "(" + "|".join(KEYWORDS) + ")"
    inside = F.col("key_inside") == 1
    named = inside | ((F.col("key_before") == 1) & (F.col("assigned") == 1))
    v = F.col("value")
    mixed = inside & (F.length(v) >= 8) & v.rlike("[0-9]") & v.rlike("[A-Za-z]") & ((F.col("transitions") * F.length(v)) >= 2)
    near = F.concat_ws(" ", "previous", "key", "next").rlike(keyword)
    secret = v.rlike(CERTAIN_SECRET) | (v.rlike(ASSIGNED_HEX) & named) | (mixed & ~v.rlike(CERTAIN_OTHER))
    other = (v.rlike(CERTAIN_OTHER) & ~inside) | (v.rlike(ASSIGNED_HEX) & ~near)
    label = F.when(F.lower(v).rlike(STAND_IN), 0.0).when(secret, 1.0).when(other, 0.0)
    return found.withColumn("label", label).where("label is not null")


def judged(found: DataFrame, findings: DataFrame) -> DataFrame:
    """Adds score, the forest's share of votes for a secret, to featured candidates.

    findings: featured candidates with a label. The forest is fitted on all of them; those of a label weigh as MAX_LABELLED / 2 together at
    most, so that the more frequent one does not outvote the other. Without labels of both kinds no forest can be fitted: the score is then
    1 where the labels are all 1, and else 0.
    """
    sizes = {r["label"]: r["count"] for r in findings.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return found.withColumn("score", F.lit(1.0 if 1.0 in sizes else 0.0))
    weight = F.when(F.col("label") == 1, min(1.0, MAX_LABELLED / 2 / sizes[1.0])).otherwise(min(1.0, MAX_LABELLED / 2 / sizes[0.0]))
    rows = stored(findings.select("label", weight.alias("_weight"), *FEATURES))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    columns = {"featuresCol": "_features", "labelCol": "label", "weightCol": "_weight", "probabilityCol": "_share", "rawPredictionCol": "_raw", "predictionCol": "_guess"}
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=32, seed=13, **columns)
    model = forest.fit(assembler.transform(rows))
    scored = model.transform(assembler.transform(found))
    return scored.withColumn("score", vector_to_array("_share")[1]).drop("_features", "_share", "_raw", "_guess")


def secrets(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Rows (id, place, value, score): the candidates of all texts that the forest takes for secrets.

    findings: reviewed candidates (columns of `candidates` and label); by default those that `labelled` labels. Dictionary words are the
    frequent ones of all texts. Null, empty and very long texts are handled alike; a repeated row gives its findings again, null ids stay null.
    Texts without candidates give no row, nor does an empty table. Columns of docs other than id, text and path are ignored, so names can't clash.
    A word is looked at as a whole: values that hold white space are not found.
    """
    dictionary = frequent_words(docs, text)
    found = stored(featured(stored(candidates(docs, id_col, text, path)), dictionary))
    known = labelled(found) if findings is None else featured(findings, dictionary)
    return judged(found, known).where(F.col("score") >= LEAST).select(F.col("id").alias(id_col), "place", "value", "score")


def redacted(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with every found value of a document replaced in its text by REDACTED; all rows and other columns stay.

    Rows without an id count as one document: what is found in any of them is replaced in all.
    """
    held, key = unused(docs, "_values"), unused(docs, "_id")
    values = found.groupBy(F.col(id_col).alias(key)).agg(F.collect_set("value").alias(held))  # the secrets of one document
    longest = F.array_sort(held, lambda a, b: F.coalesce(F.nullif(F.length(b) - F.length(a), F.lit(0)), F.when(a < b, -1).when(a > b, 1).otherwise(0)))
    clean = F.aggregate(longest, F.col(text), lambda t, v: F.replace(t, v, F.lit(REDACTED)))
    joined = docs.join(values, F.col(id_col).eqNullSafe(F.col(key)), "left")
    return joined.withColumn(text, F.when(F.col(held).isNull(), F.col(text)).otherwise(clean)).select(*docs.columns)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: position, a digest of the value, and the forest's score."""
    found = secrets(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return found.select("doc_id", "place", F.length("value").alias("n_chars"), F.sha2("value", 256).alias("digest"), F.round("score", 6).alias("score"))
