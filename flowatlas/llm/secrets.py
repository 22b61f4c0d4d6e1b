"""Secret scans: candidates by pattern, a random forest that removes false positives. DataFrame functions and ``spark.ml`` only.

A candidate is a run of at least 12 key characters with a digit, a value of any length and alphabet that a name such as ``password`` or ``api_key``
announces (``name = value``, ``name: "value"``), or a private key block. Every place where one stands becomes a row
with features: length and shares of character classes, transitions between classes, coverage by the words of the
corpus, form of a path, address or number, and the words next to it. A forest trained from labelled findings then scores each place; a value is judged by the
highest score of its places in the document.

The dictionary holds the words of the whole corpus that stand in it at least ``MIN_COUNT`` times; it is counted in Spark
with partial sums and joined with the few word parts of candidates. Candidates are found once and written; their places follow from the lengths of the
stretches between them. The training sample is bounded: ``SAMPLE_ROWS`` labelled
findings, the first in the order of a hash. Texts are never shuffled: documents without candidates pass through, and only their
findings are joined to the others.

No table of labelled findings is given here, so ``format_label`` labels those whose format settles the matter (published key formats, assigned
hexadecimal values; mail addresses, numbers, hosts) and leaves the others open; ``features`` and ``train`` take any labels.

The text before and after a place goes back over one earlier candidate, and up to the next, at most. A key block without an end goes on as long as key characters and white
space do. Confirmed secrets of ``MIN_CHARS`` characters or more are masked wherever they stand, longer ones first; shorter ones where no key character
is next to them, so that a short password does not tear words apart.

Null and empty texts have no candidates. Null ids are kept. Rows with the same id and text share their findings. Without labelled
findings of both kinds every score is the share of secrets among the labelled ones, or 0.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowatlas.llm.common import read_table, written

MIN_CHARS, MIN_COUNT, CONTEXT = 12, 5, 48
#: Bound of the training sample, a documented parameter; the forest.
SAMPLE_ROWS, TREES, DEPTH, SEED = 20_000, 24, 6, 7
#: Score from which a candidate is a secret.
CUT = 0.5
MASK = "[SECRET]"

_KEY = "A-Za-z0-9_+/.@-"
#: Words that announce a secret.
_NAMES = "(?i)(pass(word|wd|phrase)?|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key)"
#: A name with what may follow it up to the value, and the value; the quote that closes it is left outside.
_HEAD = (f"(?<![{_KEY}])[{_KEY}]{{0,64}}?(?i:pass(?:word|wd|phrase)|pwd|secret|token|api[_-]?key|access[_-]?key|authorization|auth|credential|private[_-]?key)"
         "(?:s|[_-][A-Za-z0-9_-]{1,24}|[A-Z][A-Za-z0-9]{0,24})?[\"']?[ \\t]{0,8}[=:][ \\t]{0,8}")
_VALUE = "(?:\"[^\"\\n]+(?=\")|'[^'\\n]+(?=')|[^\\s\"',;<>(){}\\[\\]=:][^\\s\"',;<>(){}\\[\\]]*)"
_MARKER = "[A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
_BLOCK = f"-----BEGIN {_MARKER}(?:[\\s\\S]*?-----END {_MARKER}|[A-Za-z0-9+/=\\s]*+)"
_RUN = f"(?<![{_KEY}])(?=[A-Za-z_+/.@-]*[0-9])[{_KEY}]{{{MIN_CHARS},}}={{0,2}}"
CANDIDATE = f"{_BLOCK}|{_HEAD}{_VALUE}|{_RUN}"

FEATURES = ["length", "digits", "uppers", "lowers", "marks", "hexadecimal", "transitions", "switches", "distinct_chars", "vowels",
            "dictionary", "slashes", "dots", "address", "numeric", "dotted_number", "in_url", "test_path", "announced", "assigned",
            "quoted", "known_before", "known_after", "key_block"]


def _key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("row_key", F.xxhash64("doc_id", "text"))


def _count(text: Column, pattern: str) -> Column:
    """Characters that the pattern leaves over."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("double")


def candidates(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """One row per document text and place of a candidate: the candidate, where it starts (from 1), its surroundings."""
    source = F.coalesce(F.col(path).cast("string"), F.lit("")) if path and path in docs.columns else F.lit("")
    rows = _key(docs.select("doc_id", "text", source.alias("path")))
    found = rows.withColumn("found", F.regexp_extract_all("text", F.lit(CANDIDATE), 0))
    found = found.filter(F.size("found") > 0).withColumn("gaps", F.split("text", CANDIDATE, -1))
    nothing = F.lit("")
    places = found.select("row_key", "doc_id", "path", F.explode(F.transform("found", lambda m, i: F.struct(
        i.alias("i"), m.alias("match"), F.length(F.get("gaps", i)).alias("gap"),
        F.concat(F.coalesce(F.get("gaps", i - 1), nothing), F.coalesce(F.get("found", i - 1), nothing), F.get("gaps", i)).substr(F.lit(-CONTEXT), F.lit(CONTEXT)).alias("earlier"),
        F.substring(F.get("gaps", i + 1), 1, CONTEXT).alias("after")))).alias("p")).select("row_key", "doc_id", "path", "p.*")
    # Repeated rows may differ in their source: one finding, with the first source in order.
    once = places.groupBy("row_key", "doc_id", "i", "match", "gap", "earlier", "after").agg(F.min("path").alias("path"))
    # The rows of one text: as many as it has candidates.
    upto = F.sum(F.col("gap") + F.length("match")).over(Window.partitionBy("row_key", "doc_id").orderBy("i"))
    head = F.regexp_extract("match", f"^(?:{_HEAD}[\"']?)(?=[^=:])", 0)
    return once.withColumns({"head": head, "upto": upto}).select(
        "row_key", "doc_id", "path", F.substr("match", F.length("head") + 1).alias("candidate"),
        (F.col("upto") - F.length("match") + F.length("head") + 1).cast("int").alias("start"),
        F.concat("earlier", "head").substr(F.lit(-CONTEXT), F.lit(CONTEXT)).alias("before"), "after")


def dictionary(docs: DataFrame) -> DataFrame:
    """``(word, n)``: words of three letters or more that stand in the corpus often enough."""
    words = docs.select(F.explode(F.split(F.lower(F.col("text")), r"[^\p{L}]+")).alias("word"))
    return words.filter(F.length("word") >= 3).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_COUNT)


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with one double column per name in ``FEATURES``."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    length = F.length(c).cast("double")
    letters = F.greatest(_count(c, "[^A-Za-z]"), F.lit(1.0))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")
    near = found.withColumns({
        "word_before": F.lower(F.regexp_extract(before, r"([\p{L}]{3,})[^\p{L}]*$", 1)),
        "word_after": F.lower(F.regexp_extract(after, r"^[^\p{L}]*([\p{L}]{3,})", 1)),
    })
    parts = near.select("row_key", "candidate", "start", F.explode(F.concat(
        F.transform(F.filter(F.split(F.lower(c), "[^a-z]+"), lambda x: F.length(x) >= 3), lambda x: F.struct(F.lit("part").alias("of"), x.alias("word"))),
        F.array(F.struct(F.lit("before").alias("of"), F.col("word_before").alias("word")),
                F.struct(F.lit("after").alias("of"), F.col("word_after").alias("word"))))).alias("p")).select("row_key", "candidate", "start", "p.of", "p.word")
    known = parts.join(words.select("word"), "word", "left_semi").groupBy("row_key", "candidate", "start").agg(
        F.sum(F.when(F.col("of") == "part", F.length("word")).otherwise(0)).alias("covered"),
        F.max((F.col("of") == "before").cast("double")).alias("known_before"),
        F.max((F.col("of") == "after").cast("double")).alias("known_after"))
    rows = found.join(known, ["row_key", "candidate", "start"], "left")
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    return rows.withColumns({
        "length": length,
        "digits": _count(c, "[^0-9]") / length,
        "uppers": _count(c, "[^A-Z]") / length,
        "lowers": _count(c, "[^a-z]") / length,
        "marks": _count(c, "[A-Za-z0-9]") / length,
        "hexadecimal": _count(c, "[^0-9a-f]") / length,
        "transitions": (F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / length,
        "switches": F.size(F.regexp_extract_all(c, F.lit("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"), 0)).cast("double"),
        "distinct_chars": F.size(F.array_distinct(F.split(c, ""))) / length,
        "vowels": _count(c, "[^AEIOUaeiou]") / letters,
        "dictionary": F.coalesce(F.col("covered"), F.lit(0)) / letters,
        "slashes": _count(c, "[^/]"),
        "dots": _count(c, "[^.]"),
        "address": flag(F.contains(c, F.lit("@"))),
        "numeric": flag(c.rlike(r"^\d+$")),
        "dotted_number": flag(c.rlike(r"^\d+(\.\d+)+$")),
        "in_url": flag(before.rlike(r"[a-z]+:/*$") | c.rlike("^//")),
        "test_path": flag(F.col("path").rlike("(?i)test|example|sample|mock|doc")),
        "announced": flag(F.substring(before, -24, 24).rlike(_NAMES)),
        "assigned": flag(before.rlike(r"""[=:]\s*["']?$""")),
        "quoted": flag(before.rlike("""["']$""") & after.rlike("""^["']""")),
        "known_before": F.coalesce("known_before", F.lit(0.0)),
        "known_after": F.coalesce("known_after", F.lit(0.0)),
        "key_block": flag(c.startswith("-----BEGIN")),
    }).drop("covered")


def format_label() -> Column:
    """1, 0 or null for findings whose format settles or leaves open what they are."""
    c, before = F.col("candidate"), F.col("before")
    named = before.rlike(_HEAD + r"""["']?$""")
    given = (named & c.rlike("^([0-9a-f]{16,}|[A-Za-z0-9+/]{32,}={0,2}|(?=.*[A-Za-z])(?=.*[0-9])\\S{6,})$")) | c.startswith("-----BEGIN")
    other = c.rlike(r"@|^[0-9.+-]+$|^//|^[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[a-z]{2,4}$")
    return F.when(c.rlike("^AKIA[0-9A-Z]{16}$") | given, 1).when(other, 0)


def train(labelled: DataFrame) -> RandomForestClassificationModel | float:
    """Forest from rows with the features and a ``label``; the share of secrets if only one kind of label is there."""
    # Bounded, in one sorted file, so the same rows always grow the same trees.
    sample = labelled.filter("label IS NOT NULL").select(*FEATURES, F.col("label").cast("double"), F.xxhash64("row_key", "candidate", "start").alias("place")) \
        .orderBy("place", *FEATURES).limit(SAMPLE_ROWS)
    sample = written(sample)
    share = sample.agg(F.avg("label")).first()[0]
    if share is None or share in (0.0, 1.0):
        return share or 0.0
    rows = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(sample).select("vector", "label")
    return RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False).fit(rows)


def scored(rows: DataFrame, model: RandomForestClassificationModel | float) -> DataFrame:
    """``(row_key, doc_id, candidate, start, score, secret)``."""
    if isinstance(model, float):
        rows = rows.withColumn("score", F.lit(model))
    else:
        rows = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(rows)) \
            .withColumn("score", vector_to_array("probability")[1])
    return rows.select("row_key", "doc_id", "candidate", "start", "score", (F.col("score") >= CUT).alias("secret"))


def findings(docs: DataFrame, path: str | None = "source", label: Column | None = None) -> DataFrame:
    """All places of candidates of ``docs`` with their scores, from a forest trained on their labelled part."""
    rows = written(features(written(candidates(docs, path)), dictionary(docs)))
    return written(scored(rows, train(rows.withColumn("label", format_label() if label is None else label))))


def _values(found: DataFrame) -> DataFrame:
    """One row per document text and candidate: its first place, the highest score of its places."""
    return found.groupBy("row_key", "candidate").agg(F.min("start").alias("start"), F.max("score").alias("score"), F.max("secret").alias("secret"))


def per_document(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row per document: distinct candidates, confirmed secrets in the order of their first places, highest score."""
    spans = _values(found).groupBy("row_key").agg(
        F.count("*").alias("n_candidates"), F.max("score").alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("secret"), F.struct("start", "candidate")))).alias("spans"))
    rows = _key(docs.select("doc_id", "text")).select("row_key", "doc_id")
    return rows.join(spans, "row_key", "left").select(
        "doc_id", F.coalesce("n_candidates", F.lit(0)).cast("long").alias("n_candidates"),
        F.greatest(F.coalesce(F.size("spans"), F.lit(0)), F.lit(0)).cast("long").alias("n_secrets"),
        F.get("spans", F.lit(0))["start"].cast("long").alias("first_char"), F.coalesce("score", F.lit(0.0)).alias("score"),
        F.sha2(F.array_join(F.coalesce(F.col("spans.candidate"), F.array().cast("array<string>")), ",").cast("binary"), 256).alias("secrets_sha256"))


def redacted(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with every confirmed secret replaced by a mask; ``n_chars``, if there, is counted anew."""
    # Longest first: a secret may stand inside another one.
    secrets = found.filter("secret").groupBy("row_key").agg(F.transform(
        F.sort_array(F.collect_set(F.struct(F.length("candidate").alias("n"), "candidate")), asc=False), lambda x: x["candidate"]).alias("secrets"))
    has = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    # Packed, so that no column of docs can clash with the key or the secrets.
    rows = docs.filter(has).select(F.xxhash64("doc_id", "text").alias("row_key"), F.struct(*docs.columns).alias("row"))
    changed = rows.join(secrets, "row_key", "left").withColumn(
        "masked", F.aggregate("secrets", F.col("row.text"), lambda text, s: F.when(F.length(s) >= MIN_CHARS, F.replace(text, s, F.lit(MASK))).otherwise(
            F.regexp_replace(text, F.concat(F.lit(f"(?<![{_KEY}])\\Q"), F.replace(s, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(f"\\E(?![{_KEY}])")), F.lit(MASK)))))
    new = {"text": F.coalesce("masked", "row.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("masked").isNotNull(), F.length("masked").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return changed.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns]).unionByName(docs.filter(~has))


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return per_document(docs, findings(docs))
