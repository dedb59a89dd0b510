"""Secret scan with a random forest that removes false positives, in DataFrame functions and Spark ML alone.

Candidates are runs of LEAST_LENGTH or more characters of the alphabet keys are written in, and runs of LEAST_ASSIGNED
or more visible characters that are assigned to the name of a secret or stand as the password of a URL. They include
long words, numbers and identifiers, so each one is described by

* length and shares of digits, capitals and signs,
* character transitions: how often the class of neighbouring characters changes, and the mean log-odds of its pairs of
  neighbouring characters in labelled secrets against labelled non-secrets,
* dictionary coverage: the share of its letter triples that occur in words of the corpus (MIN_COUNT uses at least,
  counted over all documents),
* path: depth, and whether it looks like tests or examples,
* neighbouring words: names of secrets, names of digests and identifiers, an assignment or a quote next to it,

and a forest trained on labelled findings decides. What is collected on the way is bounded: pairs and triples of an
alphabet, not rows.

``fit`` takes labelled findings. Where a corpus has none, ``weak_labels`` labels the findings that a rule can decide:
known key formats and long values assigned to the name of a secret against plain words, plain numbers and values that
are named as digests. At most SAMPLE_LABELLED findings of each label, by hash, are used.

Defined results: a null or empty text has no candidates. Rows that repeat an id are scanned one by one. Without labelled
findings of both kinds nothing can be told apart, and all candidates stay with score 0.5. An empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

LEAST_LENGTH, LEAST_ASSIGNED, CONTEXT, MIN_COUNT = 16, 6, 48, 5
SAMPLE_LABELLED, TREES, DEPTH, SEED = 4000, 40, 7, 17

#: Fixed formats of well-known keys.
FORMATS = (r"^(?:(?:AKIA|ASIA)[A-Z2-7]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_\-]{35}"
           r"|[sr]k_live_[A-Za-z0-9]{16,}|glpat-[A-Za-z0-9_\-]{20})$")
#: Fixed word lists, matched in the text next to a candidate.
SECRET_NAMES = r"(?i)(?:token|secret|passw(?:or)?d|passphrase|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer)"
OTHER_NAMES = r"(?i)(?:sha-?[0-9]*|md5|digest|checksum|commit|hash|etag|uuid|guid|revision)"
#: What a secret is assigned with, up to the value. A cheap look at the sign comes before the one at the name.
_SIGN = r"[\"']?\s{0,4}[=:]{1,2}>?\s{0,4}"
_ASSIGNED = r"(?<=[=:>\s\"'`])(?<=[=:]>?\s{0,4}[\"'`]?)(?<=" + SECRET_NAMES + r"[A-Za-z0-9_\-]{0,16}" + _SIGN + "%s)"
#: An unquoted value ends where the next name of a list of settings begins; a URL is looked into, not taken whole.
_NO_URL = r"(?![A-Za-z][A-Za-z0-9+.\-]{0,20}://)"
_BARE = (r"(?:(?![;&,][A-Za-z][A-Za-z0-9_ .\-]{0,40}[=:])[^\s\"'`]){%d,}[^\s\"'`.,;)\]}>]" % (LEAST_ASSIGNED - 1))
CANDIDATE = "|".join([
    r"(?<=:)(?<=://[^\s:@/]{0,64}:)[^\s\"'`/]{%d,}(?=@)" % LEAST_ASSIGNED,
    *(_ASSIGNED % q + _NO_URL + r"[^\s%s]{%d,}(?=%s)" % (q, LEAST_ASSIGNED, q) for q in "\"'`"),
    _ASSIGNED % "" + _NO_URL + _BARE,
    r"[A-Za-z0-9+/_\-]{%d,}={0,2}" % LEAST_LENGTH])
EXAMPLES = r"(?i)(?:test|example|sample|fixture|mock|demo|docs?/)"

#: Characters of a candidate, one place each; the first place is for any other character.
_SIGNS = "?abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-="
_WIDE = len(_SIGNS)
FEATURES = ("length", "digits", "capitals", "signs", "changes", "pair_odds", "coverage", "depth", "example_path",
            "secret_name", "other_name", "assigned", "quoted")


class Scanner(NamedTuple):
    pair_odds: list[float]
    triples: list[bool]
    forest: PipelineModel | None


def _codes(value: Column) -> Column:
    """Place of every character in _SIGNS."""
    return F.transform(F.split(value, ""), lambda c: F.greatest(F.position(c, F.lit(_SIGNS)) - 1, F.lit(0)))


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               path_column: str = "source") -> DataFrame:
    """``doc_id, path, start, value, before, after``: candidates with their place (in code points) and context.

    Finding them is what costs: write the result once where it is used for labels, training and scoring.
    """
    text = F.col(text_column)
    cut = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                      F.coalesce(F.col(path_column).cast("string"), F.lit("")).alias("path"), text.alias("text")).filter(
        text.rlike(CANDIDATE))
    cut = cut.withColumn("found", F.regexp_extract_all("text", F.lit(CANDIDATE), 0)).withColumn(
        "between", F.split("text", CANDIDATE, -1))
    # where each candidate starts, and the text before it whatever candidates lie in it
    ahead = F.aggregate(
        F.sequence(F.lit(0), F.size("found") - 1),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"),
                 F.array().cast("array<struct<start:int,before:string>>").alias("seen")),
        lambda a, i: F.struct(
            (a["at"] + F.length(F.get("between", i)) + F.length(F.get("found", i))).alias("at"),
            F.right(F.concat(a["tail"], F.get("between", i), F.get("found", i)), F.lit(CONTEXT)).alias("tail"),
            F.concat(a["seen"], F.array(F.struct(
                (a["at"] + F.length(F.get("between", i))).alias("start"),
                F.right(F.concat(a["tail"], F.get("between", i)), F.lit(CONTEXT)).alias("before")))).alias("seen")),
        lambda a: a["seen"])
    # the text behind each candidate, collected from the last one to the first
    behind = F.aggregate(
        F.sequence(F.size("found"), F.lit(1), F.lit(-1)),
        F.struct(F.lit("").alias("head"), F.array().cast("array<string>").alias("seen")),
        lambda a, i: F.struct(
            F.left(F.concat(F.get("found", i - 1), F.get("between", i), a["head"]), F.lit(CONTEXT)).alias("head"),
            F.concat(a["seen"], F.array(F.left(F.concat(F.get("between", i), a["head"]), F.lit(CONTEXT)))).alias("seen")),
        lambda a: F.reverse(a["seen"]))
    cut = cut.withColumn("ahead", ahead).withColumn("behind", behind)
    rows = cut.withColumn("c", F.transform("found", lambda v, i: F.struct(
        F.get("ahead", i)["start"].cast("long").alias("start"), v.alias("value"),
        F.get("ahead", i)["before"].alias("before"), F.get("behind", i).alias("after"))))
    return rows.select("doc_id", "path", F.inline_outer("c"))


def corpus_triples(docs: DataFrame, text_column: str = "text", min_count: int = MIN_COUNT) -> list[bool]:
    """Which of the 26 ** 3 letter triples occur in words used ``min_count`` times or more in the corpus.

    Words are counted over all documents; the triples that come to the driver are those of an alphabet of 26.
    """
    words = docs.select(F.explode_outer(F.split(F.lower(text_column), "[^a-z]+")).alias("w")).filter(
        F.length("w").between(3, LEAST_LENGTH - 1))
    common = words.groupBy("w").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)
    triples = common.select(F.explode_outer(F.transform(
        F.sequence(F.lit(1), F.length("w") - 2), lambda i: F.substring(F.col("w"), i, F.lit(3)))).alias("t")).distinct()
    known = [False] * 26 ** 3
    for row in triples.collect():  # 17,576 at most
        a, b, c = (ord(x) - 97 for x in row.t)
        known[(a * 26 + b) * 26 + c] = True
    return known


def _described(found: DataFrame, pair_odds: list[float], triples: list[bool], carry: tuple[str, ...] = ()) -> DataFrame:
    odds = F.array(*(F.lit(float(x)) for x in pair_odds))
    # one literal string of 0 and 1 is cheaper to plan than an array of 17,576 literals
    known = F.lit("".join("1" if t else "0" for t in triples))
    n = F.length("value")
    rows = found.withColumn("codes", _codes(F.col("value"))).withColumn(
        "letters", F.split(F.regexp_replace(F.lower("value"), "[^a-z]+", " "), ""))
    pairs = F.transform(F.slice("codes", F.lit(1), F.size("codes") - 1),
                        lambda c, i: c * _WIDE + F.get("codes", i + 1))
    rows = rows.withColumn("pairs", pairs)

    def place(x):
        return F.ascii(x) - 97

    def triple(x, i):
        y, z = F.get("letters", i + 1), F.get("letters", i + 2)
        return F.when((x != " ") & (y != " ") & (z != " ") & (x != "") & (z != ""),
                      F.substring(known, (place(x) * 26 + place(y)) * 26 + place(z) + 1, F.lit(1)).cast("double"))

    rows = rows.withColumn("known", F.array_compact(F.transform("letters", triple)))
    total = F.aggregate("pairs", F.lit(0.0), lambda a, p: a + F.coalesce(F.get(odds, p), F.lit(0.0)))
    covered = F.aggregate("known", F.lit(0.0), lambda a, k: a + k)

    def share(pattern):
        return F.regexp_count("value", F.lit(pattern)) / n

    def has(column, pattern):
        return F.col(column).rlike(pattern).cast("double")

    changes = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"
    return rows.select(
        "doc_id", "path", "start", "value", "before", "after", n.cast("double").alias("length"),
        share("[0-9]").alias("digits"), share("[A-Z]").alias("capitals"), share(r"[+/_\-=]").alias("signs"),
        (F.regexp_count("value", F.lit(changes)) / (n - 1)).alias("changes"),
        (total / F.greatest(F.size("pairs"), F.lit(1))).alias("pair_odds"),
        (covered / F.greatest(n - 2, F.lit(1))).alias("coverage"),
        F.regexp_count("path", F.lit("/")).cast("double").alias("depth"), has("path", EXAMPLES).alias("example_path"),
        has("before", SECRET_NAMES).alias("secret_name"), has("before", OTHER_NAMES).alias("other_name"),
        has("before", r"[=:]\s*[\"'`]?$").alias("assigned"), has("after", r"^[\"'`]").alias("quoted"), *carry)


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings with ``label`` 1 or 0 where a rule can tell; the others are left out."""
    value, before = F.col("value"), F.col("before")
    plain = value.rlike(r"^(?:[A-Za-z]?[a-z]+|[0-9]+|[A-Za-z]?[a-z]+(?:[-_/][A-Za-z]?[a-z]+)+)$")
    named = before.rlike(SECRET_NAMES + r"[A-Za-z_\-]{0,16}[\"']?\s*[=:]\s*[\"'`]?$")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    digest = before.rlike(OTHER_NAMES + r"[\"']?\s*[=:]?\s*[\"'`]?$")
    return found.withColumn("label", F.when(value.rlike(FORMATS) | (named & mixed), 1.0).when(
        plain | digest, 0.0)).filter("label is not null")


def fit(docs: DataFrame, labelled: DataFrame, text_column: str = "text", sample: int = SAMPLE_LABELLED,
        withheld: tuple[str, ...] = ()) -> Scanner:
    """Train on labelled findings: the columns of :func:`candidates` and ``label``; ``withheld`` features are not used."""
    triples = corpus_triples(docs, text_column)
    order = F.xxhash64(F.col("doc_id").cast("string"), "start")
    drawn = staged(labelled.filter("label = 1").orderBy(order, "value").limit(sample).unionByName(
        labelled.filter("label = 0").orderBy(order, "value").limit(sample)), "labelled-findings")
    rows = drawn.select("label", "value").withColumn("codes", _codes(F.col("value")))
    rows = rows.withColumn("pairs", F.transform(F.slice("codes", F.lit(1), F.size("codes") - 1),
                                                lambda c, i: c * _WIDE + F.get("codes", i + 1)))
    counts = rows.select("label", F.explode_outer("pairs").alias("pair")).groupBy(
        "label", "pair").count().collect()  # pairs of an alphabet
    seen = {1.0: [1.0] * _WIDE ** 2, 0.0: [1.0] * _WIDE ** 2}
    for r in counts:
        seen[r.label][r.pair] += r["count"]
    totals = {k: sum(v) for k, v in seen.items()}
    odds = [math.log(a / totals[1.0]) - math.log(b / totals[0.0]) for a, b in zip(seen[1.0], seen[0.0])]
    sizes = {r.label: r["count"] for r in drawn.groupBy("label").count().collect()}  # two rows at most
    if len(sizes) < 2:
        return Scanner(odds, triples, None)
    # both labels weigh the same: a secret may be one finding in hundreds
    weight = F.when(F.col("label") == 1, sum(sizes.values()) / (2 * sizes[1.0])).otherwise(
        sum(sizes.values()) / (2 * sizes[0.0]))
    described = staged(_described(drawn.withColumn("weight", weight), odds, triples, ("label", "weight")), "described")
    forest = Pipeline(stages=[
        VectorAssembler(inputCols=[f for f in FEATURES if f not in withheld], outputCol="features"),
        RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED)]).fit(described)
    return Scanner(odds, triples, forest)


def scored(found: DataFrame, scanner: Scanner, carry: tuple[str, ...] = ()) -> DataFrame:
    """Candidates with their features and ``score``."""
    described = _described(found, scanner.pair_odds, scanner.triples, carry)
    if scanner.forest is None:
        return described.withColumn("score", F.lit(0.5))
    return scanner.forest.transform(described).withColumn("score", vector_to_array("probability")[1])


def held_out_quality(docs: DataFrame, labelled: DataFrame, text_column: str = "text", withheld: tuple[str, ...] = (),
                     least: float = 0.5, folds: int = 5) -> DataFrame:
    """One row ``n, secrets, found, right``: labelled findings of held-out documents, those labelled 1, those that the
    forest retains, and those retained and labelled 1.

    A document is held out as a whole: one fold of crc32 over its id as text. Withhold the features that decide the
    labels to see what the others find by themselves.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))
    scanner = fit(docs, labelled.filter(~held), text_column, withheld=withheld)
    judged = scored(labelled.filter(held), scanner, ("label",))
    retained, secret = F.col("score") >= least, F.col("label") == 1
    return judged.agg(F.count("*").alias("n"), F.count_if(secret).alias("secrets"), F.count_if(retained).alias("found"),
                      F.count_if(retained & secret).alias("right"))


def secrets(found: DataFrame, scanner: Scanner, least: float = 0.5) -> DataFrame:
    """Candidates that the forest retains: ``doc_id, path, start, length, value_sha256, kind, score``.

    The secret itself is not repeated in the output; its place and digest are.
    """
    return scored(found, scanner).filter(F.col("score") >= least).select(
        "doc_id", "path", "start", F.length("value").cast("long").alias("length"),
        F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
        F.when(F.col("value").rlike(FORMATS), "known format").otherwise("value").alias("kind"), "score")
