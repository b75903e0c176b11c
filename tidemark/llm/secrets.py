"""Secret scanning: candidates from all texts, and a random forest that takes false positives out.

Everything is a DataFrame expression, an aggregation or a Spark ML estimator. Candidates are runs of key characters in
the words of a text, each run one of its own. The forest sees a candidate's length, its changes of character class and how common its letter
pairs are in ordinary words, the share of it that dictionary words cover, whether it is part of a path, and the words
around it. It is trained on labelled findings: the caller's, or those of ``rule_labels``.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import bounded_sample, free_name
from tidemark.session import materialise

RUN = "[A-Za-z0-9+/=_-]{16,}"
#: Words that announce a secret, and the strings that join a name and its value.
NAMES = "(?i)(secret|token|passw|pwd|api|key|auth|cred|bearer|private)"
JOINS = "(=|:|:=|=>) ?[\"'`]?$"
NEAR = 200
FEATURES = [
    "length", "changes", "digits", "uppers", "variety", "hexadecimal", "pairs", "dictionary", "path", "quoted",
    "announced", "joined",
]


def find_candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, place, word, candidate, before, after``: every run of 16 or more key characters.

    ``place`` is the number of the word in its text. Where it has one run, ``word`` is the whole word, ``before`` the two
    words before it and the part of it before the run, ``after`` the next word. Of several runs each is a finding of its
    own: its ``word`` reaches from the run before to the run after, ``before`` holds also the run before (and of the two
    words the last NEAR characters), ``after`` is the next run; so a long text without spaces gives no more than a few
    times its size. Null and blank texts have no words; repeated rows and null keys give their own findings. Other
    columns are ignored.
    """
    words = docs.select(F.col(key), F.split(F.btrim(F.col(text), F.lit(" \t\n\x0b\f\r")), "[ \\t\\n\\x0b\\f\\r]+").alias("words"))
    places = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0))),
        lambda i: (F.length(F.get("words", i)) >= 16) & F.get("words", i).rlike(RUN),
    )
    found = words.where(F.size("words") > 0).select(key, "words", F.explode(places).alias("place"))
    near = lambda d: F.coalesce(F.get("words", F.col("place") + d), F.lit(""))
    runs, gaps = F.regexp_extract_all(near(0), F.lit(RUN), F.lit(0)), F.split(near(0), RUN, -1)
    one, none = F.size(runs) == 1, F.array(F.lit(""))
    later = lambda x: F.slice(x, F.lit(2), F.size(x))
    whole = F.concat_ws(" ", near(-2), near(-1))
    parts = F.arrays_zip(
        runs.alias("run"), F.concat(none, runs).alias("last"), later(runs).alias("next"), gaps.alias("gap"),
        F.concat(none, gaps).alias("last_gap"), later(gaps).alias("next_gap"),
    )
    cut = found.select(
        key, "place", F.when(one, whole).otherwise(F.right(whole, F.lit(NEAR))).alias("whole"),
        F.when(one, near(1)).otherwise(F.left(near(1), F.lit(NEAR))).alias("after"), F.explode(parts).alias("part"),
    ).where("part.run IS NOT NULL")
    within = F.concat("part.last_gap", "part.last", "part.gap")
    return cut.select(
        key, "place", F.concat("part.gap", "part.run", "part.next_gap").alias("word"), F.col("part.run").alias("candidate"),
        F.concat("whole", F.when(within != "", F.concat(F.lit(" "), within)).otherwise("")).alias("before"),
        F.coalesce("part.next", "after").alias("after"),
    )


def dictionary(docs: DataFrame, text: str = "text", least: int = 3) -> DataFrame:
    """``part, n``: lower-case runs of three or more letters seen at least ``least`` times in all texts."""
    parts = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z]{3,}"), F.lit(0))).alias("part"))
    return parts.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _letters(candidate: Column) -> Column:
    """The letter runs of a candidate, cut also where a capital follows a small letter."""
    apart = F.regexp_replace(candidate, "([a-z])([A-Z])", "$1 $2")
    return F.regexp_extract_all(F.lower(apart), F.lit("[a-z]{3,}"), F.lit(0))


def _pairs(text: Column) -> Column:
    """Every two neighbouring characters, in one pass over the text."""
    return F.regexp_extract_all(text, F.lit("(?=(..))"), F.lit(1))


def measure(findings: DataFrame, words: DataFrame) -> DataFrame:
    """``findings`` with the columns of FEATURES; ``words`` is the result of ``dictionary``.

    Each different candidate is measured once; what is exploded from it carries its number, not its text. Pairs of the 36 letters and digits make at most 1,296 rows, so their
    table may be broadcast; dictionary parts are joined by shuffle.
    """
    own = findings.select("candidate").distinct().withColumn("_id", F.monotonically_increasing_id())
    own = materialise(own, "candidates")
    counts = words.select("n", F.explode(_pairs(F.col("part"))).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n").alias("all"))
    logs = counts.join(F.broadcast(total)).select("pair", F.log(F.col("n") / F.col("all")).alias("log"))
    pairs = own.select("_id", F.explode(_pairs(F.lower("candidate"))).alias("pair"))
    usual = pairs.join(F.broadcast(logs), "pair", "left").groupBy("_id").agg(
        F.avg(F.coalesce("log", F.lit(-16.0))).alias("pairs")
    )
    parts = own.select("_id", F.explode(_letters(F.col("candidate"))).alias("part"))
    known = parts.join(words.select("part"), "part").groupBy("_id").agg(F.sum(F.length("part")).alias("known"))
    measured = own.join(usual, "_id", "left").join(known, "_id", "left")
    c, size = F.col("candidate"), F.length("candidate")
    share = lambda kind: F.length(F.regexp_replace(c, f"[^{kind}]", "")) / size
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    flag = lambda x: x.cast("double")
    by_candidate = measured.select(
        "candidate", size.cast("double").alias("length"), (F.length(shape) / size).alias("changes"),
        share("0-9").alias("digits"), share("A-Z").alias("uppers"),
        (F.size(F.array_distinct(F.split(c, ""))) / size).alias("variety"),
        flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hexadecimal"), F.coalesce("pairs", F.lit(-16.0)).alias("pairs"),
        (F.coalesce("known", F.lit(0)) / size).alias("dictionary"),
    )
    return findings.join(by_candidate, "candidate").select(
        *findings.columns, *[x for x in by_candidate.columns if x != "candidate"],
        flag(F.col("word").rlike("[/\\\\].*[/\\\\]|://|@|\\.[A-Za-z]{2,4}\\b")).alias("path"),
        flag(F.col("word").rlike("[\"'`]")).alias("quoted"),
        flag(F.col("before").rlike(NAMES) | F.col("word").rlike(f"{NAMES}[^ ]*[=:]")).alias("announced"),
        flag(F.col("before").rlike(JOINS)).alias("joined"),
    )


def rule_labels(measured: DataFrame) -> DataFrame:
    """Findings that plain rules are sure of, with ``label``: 1 a secret, 0 none; the others are left out.

    Sure secrets are assigned to a telling name, quoted, and mix digits with letters; sure others are all letters, all
    digits, or part of a path or address.
    """
    c = F.col("candidate")
    yes = (F.col("announced") == 1) & (F.col("joined") == 1) & (F.col("quoted") == 1) & c.rlike("[0-9]") & c.rlike("[A-Za-z]")
    no = c.rlike("^[A-Za-z]+$") | c.rlike("^[0-9=-]+$") | (F.col("path") == 1)
    return measured.withColumn("label", F.when(yes, 1.0).when(no, 0.0)).where("label IS NOT NULL")


def train(labelled: DataFrame, most_rows: int = 20_000, trees: int = 20, depth: int = 6) -> RandomForestClassificationModel | None:
    """A forest from labelled, measured findings; None unless both labels occur.

    It sees at most ``most_rows`` different ones of each label, those with the smallest hash of their candidate, in a
    fixed order, so the same findings give the same forest. Null labels teach nothing.
    """
    rows = labelled.where("label IS NOT NULL").select("label", *FEATURES, "candidate").distinct()
    sample = bounded_sample(rows.where("label = 1"), "candidate", most_rows).unionByName(
        bounded_sample(rows.where("label = 0"), "candidate", most_rows)
    )
    ordered = sample.repartition(1).sortWithinPartitions("candidate", "label", *FEATURES)
    fixed = materialise(ordered, "secret-labels").coalesce(1)
    if fixed.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", numTrees=trees, maxDepth=depth, seed=7, predictionCol="_secret",
        probabilityCol="_probability", rawPredictionCol="_raw",
    )
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(fixed))


def judge(measured: DataFrame, model: RandomForestClassificationModel | None, column: str = "secret") -> tuple[DataFrame, str]:
    """``measured`` with a boolean column, true for secrets, and its name; without a model every finding is one."""
    name = free_name(measured, column)
    if model is None:
        return measured.withColumn(name, F.lit(True)), name
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(measured))
    return scored.select(*measured.columns, (F.col("_secret") == 1).alias(name)), name
