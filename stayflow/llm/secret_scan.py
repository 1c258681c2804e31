"""Find secrets, with a random forest to take out false positives.

A candidate is a long run of the characters that keys are made of. A forest
votes on its length, its character transitions, how much of it is covered by
common letter groups, the path it is in and the words around it. The forest is
trained by Spark's own trainer from a bounded number of labelled findings and
then written as one SQL expression, so scanning is a projection: no shuffle, no
Python, and nothing that grows with the data leaves a task. All features take
time in proportion to a candidate's length, also where that is megabytes.

Very long texts are read whole. Ties: equal findings with equal contexts are
one for the fit, and judged alike. Nulls: a null text has no candidates; a null path is an empty one. Repeated
rows get a row each, empty tables none. Without findings of both labels the
forest is a single vote: the label there is, or none found. Extra columns of
any name are kept by ``redact`` and not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import fresh
from stayflow.session import materialize

#: A candidate, and the words that name a secret.
CANDIDATE = r"[A-Za-z0-9+/_=.~-]{16,}"
KEYWORDS = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|bearer|credential)"
PLACEHOLDERS = r"(?i)(example|sample|dummy|placeholder|your|xxxx|test|changeme|0000|1234)"
PATHS = r"(?i)(test|example|fixture|sample|doc|mock|readme)"
#: Words that announce a hash or an identifier, which look random and are no secrets.
_HASH = r"(commit|sha-?[0-9]{0,3}|md5|checksum|integrity|etag|digest|uuid|guid|revision|hash|blob)"
HASHES, HASH_INSIDE = rf"(?i)(?:^|[^a-z]){_HASH}[^A-Za-z0-9]{{0,6}}$", rf"(?i)^{_HASH}[=_.-]"
#: Keys that are known by their form.
KNOWN = r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|xox[abprs]-[A-Za-z0-9-]{10}|[sr]k_live_[A-Za-z0-9]{16}|AIza[A-Za-z0-9_-]{35}|(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8}"
PEM = r"PRIVATE KEY-----\s*$"
#: Values that look drawn at random: runs of letters and digits that take turns, or of letters in both cases that do. Every run is read once.
RANDOM = (
    r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9]++[A-Za-z]++[0-9])[A-Za-z0-9]{16,}"
    r"|(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[A-Z0-9]*+[a-z]++[A-Z0-9]++[a-z]++(?:[0-9][A-Z0-9]*+[a-z]++)*+[A-Z])[A-Za-z0-9]{16,}"
    r"|^(?=[^A-Z]*+[A-Z])(?=[^a-z]*+[a-z])(?=[^0-9]*+[0-9])[A-Za-z0-9+/=]{24,}$"
)
CONTEXT = 32
#: Fewer findings of a form than this are repeated for the fit, so that trees see them.
LEAST_OF_FORM = 200
#: Classes of characters for transitions: 26 letters in either case, ten digits, and all else.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
FEATURES = ("length", "letters", "digits", "uppers", "distinct", "transitions", "coverage", "separators", "keyword_before", "keyword_after", "assigned", "quoted", "placeholder", "in_url", "in_path", "hash_before")
REDACTED = "[SECRET]"


def candidates(text: Column) -> Column:
    """Array of (value, before, after) in text order; the text is these and what stands between."""
    text = F.coalesce(text, F.lit(""))
    between = F.split(text, CANDIDATE, -1)
    values = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    return F.transform(
        F.arrays_zip(values.alias("value"), F.slice(between, F.lit(1), F.size(values)).alias("before"), F.slice(between, F.lit(2), F.size(values)).alias("after")),
        lambda c: F.struct(c["value"].alias("value"), F.right(c["before"], F.lit(CONTEXT)).alias("before"), F.left(c["after"], F.lit(CONTEXT)).alias("after")),
    )


@dataclass
class Language:
    """What plain text looks like: logarithms of character transitions, and the letter groups it is made of."""

    transitions: list[float]
    groups: str

    def measures(self, value: Column) -> Column:
        """(transitions, coverage, distinct) of a value, in one pass over its bytes.

        Mean logarithm over neighbouring characters, share of three-letter
        groups that plain text is made of, and share of different characters.
        """
        side = len(ALPHABET) + 1
        kind = F.lit(np.array([ALPHABET.find(chr(c)) + 1 for c in range(128)], np.int32))
        letter = F.lit(np.array([LETTERS.find(chr(c).lower()) + 1 for c in range(128)], np.int32))
        table = F.lit(np.array(self.transitions, np.float64))
        width = len(LETTERS) + 1
        known = bytearray(width**3)
        for group in self.groups.strip("|").split("|"):
            if len(group) == 3:
                a, b, c = (LETTERS.index(x) + 1 for x in group)
                known[(a * width + b) * width + c] = 1
        common = F.lit(bytes(known))

        def step(acc: Column, raw: Column, k: Column) -> Column:
            byte = F.ascii(F.substring(raw, k, F.lit(1)).cast("string"))
            at, here = F.element_at(kind, byte + 1), F.element_at(letter, byte + 1)
            logarithm = F.when(k > 1, F.element_at(table, acc["at"] * side + at + 1)).otherwise(F.lit(0.0))
            place = (acc["first"] * width + acc["second"]) * width + here
            bit = F.lit(1).cast("bigint")
            return F.struct(
                at.alias("at"),
                acc["second"].alias("first"),
                here.alias("second"),
                (acc["total"] + logarithm).alias("total"),
                (acc["covered"] + F.when(F.substring(common, place + 1, F.lit(1)) == F.lit(b"\1"), 1).otherwise(0)).alias("covered"),
                acc["low"].bitwiseOR(F.when(byte < 64, F.call_function("shiftleft", bit, byte)).otherwise(F.lit(0).cast("bigint"))).alias("low"),
                acc["high"].bitwiseOR(F.when(byte >= 64, F.call_function("shiftleft", bit, byte - 64)).otherwise(F.lit(0).cast("bigint"))).alias("high"),
            )

        def told(acc: Column, n: Column) -> Column:
            return F.struct(
                F.when(n > 1, acc["total"] / (n - 1)).otherwise(F.lit(0.0)).alias("transitions"),
                F.when(n > 2, acc["covered"] / (n - 2)).otherwise(F.lit(0.0)).alias("coverage"),
                ((F.bit_count(acc["low"]) + F.bit_count(acc["high"])) / n).alias("distinct"),
            )

        none, zero = F.lit(0), F.lit(0).cast("bigint")
        start = F.struct(none.alias("at"), none.alias("first"), none.alias("second"), F.lit(0.0).alias("total"), none.alias("covered"), zero.alias("low"), zero.alias("high"))
        measured = lambda raw: F.aggregate(F.sequence(F.lit(1), F.octet_length(raw)), start, lambda acc, k: step(acc, raw, k), lambda acc: told(acc, F.octet_length(raw)))
        # the bytes are taken once, not at every step
        return F.transform(F.array(value.cast("binary")), measured)[0]


def at_code(value: Column, k: Column, side: int) -> Column:
    """Place of the transition from character k to the next in the table, counted from 1; for short words."""
    index = lambda place: F.instr(F.lit(ALPHABET), F.substring(value, place, F.lit(1)))
    return (index(k) * F.lit(side) + index(k + F.lit(1)) + F.lit(1)).cast("int")


def plain_language(documents: DataFrame, groups: int = 400) -> Language:
    """Transitions and letter groups counted over the whole texts of all documents.

    Equal words are counted in the tasks first; only the two bounded tables reach the driver.
    """
    words = documents.select(F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z]{3,15}"), F.lit(0))).alias("word"))
    words = materialize(words.groupBy("word").count(), "words")
    side = len(ALPHABET) + 1
    pairs = words.select("count", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda k: at_code(F.col("word"), k, side))).alias("code")).groupBy("code").agg(F.sum("count").alias("count"))
    counts = {r["code"]: r["count"] for r in pairs.collect()}
    rows = [sum(counts.get(i * side + j + 1, 0) for j in range(side)) for i in range(side)]
    transitions = [math.log((counts.get(i * side + j + 1, 0) + 0.1) / (rows[i] + 0.1 * side)) for i in range(side) for j in range(side)]
    triples = words.select("count", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 2), lambda k: F.lower(F.substring("word", k, F.lit(3))))).alias("group"))
    common = triples.groupBy("group").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "group").limit(groups).collect()
    return Language(transitions, "|" + "".join(f"{r['group']}|" for r in common))


def announced(before: Column, value: Column) -> Column:
    """Whether a value is called a hash or an identifier, by the word before it or its own beginning."""
    return F.rlike(before, F.lit(HASHES)) | F.rlike(value, F.lit(HASH_INSIDE))


def features(candidate: Column, path: Column, language: Language) -> Column:
    """Numbers on a candidate (value, before, after), in the order of FEATURES."""
    value, before, after = candidate["value"], candidate["before"], candidate["after"]
    length = F.length(value)
    share = lambda pattern: F.length(F.regexp_replace(value, pattern, "")) / length
    flag = lambda c: c.cast("double")
    numbers = lambda measured: F.array(
        length.cast("double"),
        share("[^A-Za-z]"), share("[^0-9]"), share("[^A-Z]"),
        measured["distinct"], measured["transitions"], measured["coverage"],
        share("[^+/_=.~-]"),
        flag(F.rlike(before, F.lit(KEYWORDS))), flag(F.rlike(after, F.lit(KEYWORDS))),
        flag(F.rlike(before, F.lit(r"[=:]\s*[\"']?$"))), flag(F.rlike(before, F.lit(r"[\"']$")) & F.rlike(after, F.lit(r"^[\"']"))),
        flag(F.rlike(value, F.lit(PLACEHOLDERS))),
        flag(F.rlike(before, F.lit(r"(://|@|/)\S*$")) | F.contains(value, F.lit("/"))),
        flag(F.rlike(path, F.lit(PATHS))),
        flag(announced(before, value)),
    )
    return F.transform(F.array(language.measures(value)), numbers)[0]


def findings(documents: DataFrame, path: str | None = None) -> DataFrame:
    """One row per candidate: value, before, after, path."""
    at = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    return documents.where(F.rlike("text", F.lit(CANDIDATE))).select(at.alias("path"), F.inline(candidates(F.col("text")))).select("value", "before", "after", "path")


def label_by_assignment(found: DataFrame) -> DataFrame:
    """Labels and ``form`` from the form of a finding, for tables that come without any.

    True: keys of a known form, the first line of a private key, values assigned
    to a name of a secret, in quotes or not, that look random or are in quotes
    and have 32 characters with digits. False: no name of a secret before or in
    it, and neither a known form nor random looking; or announced as a hash or
    identifier. All others are left out: placeholders, bare random strings, and
    named values without that look.
    """
    value, before = F.col("value"), F.col("before")
    random, known = F.rlike(value, F.lit(RANDOM)), F.rlike(value, F.lit(KNOWN))
    named = F.rlike(before, F.lit(KEYWORDS)) | F.rlike(value, F.lit(KEYWORDS))
    quoted = F.rlike(before, F.lit(KEYWORDS[:-1] + r")\w*\s*[=:]\s*[\"']$"))
    unquoted = F.rlike(before, F.lit(KEYWORDS[:-1] + r")\w*\s*[=:]\s*$")) | F.rlike(value, F.lit(KEYWORDS[:-1] + r")\w{0,40}=\S{16}"))
    real = ~F.rlike(value, F.lit(PLACEHOLDERS))
    form = (
        F.when(~named & ~known & announced(before, value), F.lit("hash"))
        .when(real & known, F.lit("known"))
        .when(F.rlike(before, F.lit(PEM)), F.lit("pem"))
        .when(real & quoted & (random | (F.rlike(value, F.lit("[0-9]")) & (F.length(value) >= 32))), F.lit("quoted"))
        .when(real & unquoted & random, F.lit("unquoted"))
        .when(~named & ~random & ~known, F.lit("plain"))
    )
    return found.withColumn("form", form).where("form is not null").withColumn("label", F.when(F.col("form").isin("plain", "hash"), 0.0).otherwise(1.0))


@dataclass
class Forest:
    """Trees as nested (feature, threshold, left, right) with votes at the leaves."""

    trees: list

    def score(self, feature: Column) -> Column:
        """Share of the trees that vote for a secret."""

        def vote(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            at, threshold, left, right = node
            return F.when(F.element_at(feature, F.lit(at + 1)) <= F.lit(threshold), vote(left)).otherwise(vote(right))

        total = F.lit(0.0)
        for tree in self.trees:
            total = total + vote(tree)
        return total / F.lit(float(max(1, len(self.trees))))


def _tree(node) -> float | tuple:
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return split.featureIndex(), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def drawn_findings(labelled: DataFrame, per_label: int = 4_000) -> DataFrame:
    """At most ``per_label`` different findings of each label, those of the smallest hashes.

    Where findings have a ``form``, the forms of a label share its number evenly.
    All findings are counted first. From the counts comes a share per label and
    form that is about twice enough, so tasks send few rows.
    """
    form = F.col("form") if "form" in labelled.columns else F.lit("")
    keyed = labelled.select("value", "before", "after", "path", "label", form.alias("form")).withColumn("draw", F.xxhash64("value", "before", "after", "path"))
    counts = {(r["label"], r["form"]): r["n"] for r in keyed.groupBy("label", "form").agg(F.approx_count_distinct("draw").alias("n")).collect()}
    most = {kind: max(1, per_label // sum(label == kind[0] for label, _ in counts)) for kind in counts}
    of_kind = lambda kind: (F.col("label") == kind[0]) & F.col("form").eqNullSafe(F.lit(kind[1]))
    share = F.lit(0.0)
    for kind, n in counts.items():
        share = F.when(of_kind(kind), F.lit(2.0 * most[kind] / max(n, 1))).otherwise(share)
    # the smallest hashes, in the order that the last step takes them
    place = (F.col("draw").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    some = materialize(keyed.where(place <= share).distinct(), "drawn")
    out = some.limit(0)
    for kind in sorted(counts, key=repr):
        out = out.unionByName(some.where(of_kind(kind)).orderBy("draw", "value", "before", "after", "path").limit(most[kind]))
    return out


def train_forest(labelled: DataFrame, language: Language, per_label: int = 4_000, trees: int = 15, depth: int = 5, seed: int = 42) -> Forest:
    """A forest from at most ``per_label`` findings of each label, drawn by hash from all of them.

    ``labelled`` has value, before, after, path and label (1.0 for a secret),
    and may have a form. Secrets are also shown without the words around them,
    as a bare key is still one; few findings of a form are shown repeatedly.
    """
    drawn = drawn_findings(labelled, per_label).select("value", "before", "after", "path", "label", "form")
    bare = drawn.where("label = 1.0").withColumn("before", F.lit("")).withColumn("after", F.lit("")).withColumn("form", F.concat("form", F.lit(" bare")))
    vector = features(F.struct("value", "before", "after"), F.col("path"), language)
    data = materialize(drawn.unionByName(bare).select("label", "form", vector.alias("numbers")), "findings")
    kinds = {(r["label"], r["form"]): r["count"] for r in data.groupBy("label", "form").count().collect()}
    labels = {label for label, _ in kinds}
    if len(labels) < 2:
        return Forest([1.0 if labels == {1.0} else 0.0])
    times = F.lit(1)
    for (label, form), n in sorted(kinds.items(), key=repr):
        times = F.when((F.col("label") == label) & F.col("form").eqNullSafe(F.lit(form)), F.lit(-(-LEAST_OF_FORM // n))).otherwise(times)
    data = data.select("label", "numbers", F.explode(F.sequence(F.lit(1), times)))
    data = data.select("label", array_to_vector("numbers").alias("features"))
    return fitted(data, trees, depth, seed)[1]


def fitted(data: DataFrame, trees: int, depth: int, seed: int) -> tuple[RandomForestClassificationModel, Forest]:
    """Spark's model of ``label`` by ``features``, and its trees."""
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(data)
    return model, Forest([_tree(t._call_java("rootNode")) for t in model.trees])


def _marked(documents: DataFrame, language: Language, forest: Forest, path: str | None, least_score: float, column: str) -> DataFrame:
    """The documents with an array of (value, before, after, score, secret) of every candidate."""
    at = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    found = candidates(F.col("text"))
    scored = F.transform(found, lambda c: F.struct(c["value"].alias("value"), c["before"].alias("before"), c["after"].alias("after"), features(c, at, language).alias("numbers")))
    judged = F.transform(scored, lambda c: F.struct(c["value"].alias("value"), c["before"].alias("before"), c["after"].alias("after"), forest.score(c["numbers"]).alias("score")))
    judged = F.transform(judged, lambda c: c.withField("secret", c["score"] >= F.lit(least_score)))
    none = F.array().cast("array<struct<value:string,before:string,after:string,score:double,secret:boolean>>")
    return documents.withColumn(column, F.when(F.rlike("text", F.lit(CANDIDATE)), judged).otherwise(none))


def learn(documents: DataFrame, labelled: DataFrame | None, path: str | None) -> tuple[Language, Forest]:
    """What plain text looks like, and the forest.

    Without ``labelled`` findings those of all documents are labelled by
    ``label_by_assignment``; only the fit is bounded, per label.
    """
    language = plain_language(documents)
    if labelled is None:
        # counted and drawn from: written, so that texts are searched once
        labelled = materialize(label_by_assignment(findings(documents, path)), "labelled")
    return language, train_forest(labelled, language)


def scan(documents: DataFrame, labelled: DataFrame | None = None, path: str | None = None, least_score: float = 0.5) -> DataFrame:
    """The documents with ``findings``: every candidate with its context, score and verdict."""
    language, forest = learn(documents, labelled, path)
    return _marked(documents.drop("findings"), language, forest, path, least_score, "findings")


def secret_report(documents: DataFrame, path: str | None = "source", least_score: float = 0.5) -> DataFrame:
    """One row per document: doc_id, n_candidates, n_secrets, secrets, top_score, redacted_sha256."""
    name = "findings"
    found = scan(documents.select("doc_id", "text", *([path] if path else [])), None, path, least_score)
    secrets = F.transform(F.filter(name, lambda c: c["secret"]), lambda c: c["value"])
    return found.select(
        "doc_id",
        F.size(name).cast("bigint").alias("n_candidates"),
        F.size(F.filter(name, lambda c: c["secret"])).cast("bigint").alias("n_secrets"),
        F.coalesce(F.array_max(F.transform(name, lambda c: c["score"])), F.lit(0.0)).alias("top_score"),
        secrets.alias("secrets"),
        F.sha2(redacted(F.col("text"), F.col(name)).cast("binary"), 256).alias("redacted_sha256"),
    )


def redacted(text: Column, found: Column) -> Column:
    """The text with every secret of ``found`` replaced; null stays null."""
    between = F.split(text, CANDIDATE, -1)
    pieces = F.transform(found, lambda c: F.when(c["secret"], F.lit(REDACTED)).otherwise(c["value"]))
    joined = F.zip_with(between, pieces, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(F.exists(found, lambda c: c["secret"]), F.array_join(joined, "")).otherwise(text)


def redact(documents: DataFrame, path: str | None = None, least_score: float = 0.5) -> DataFrame:
    """The documents with every secret in ``text`` replaced, all other columns as they are."""
    name = fresh(documents.columns, "findings")
    language, forest = learn(documents, None, path)
    marked = _marked(documents, language, forest, path, least_score, name)
    return marked.select(*[redacted(F.col("text"), F.col(name)).alias(c) if c == "text" else F.col(f"`{c}`") for c in documents.columns])
