"""Secret scan with a random forest that removes false positives, in DataFrame functions only.

Candidates are known key formats (also inside a longer token), values assigned
to a key word or in a URL's password place (of any length and characters), and
long tokens with a digit. Their features: length, shares of character classes,
class changes, how usual their letter pairs are in the corpus's words, how much
of them dictionary words cover, how path-like they are, and the words before them. A random forest is trained from labelled
findings; without such a table, findings that a known key format or an
assignment to a key word (secrets), or a plain number, an identifier format or
a checksum word (no secrets) decides are the labels. The forest judges all
but known key formats, which are secrets in any case.

The dictionary and letter pairs are counted over the words of all documents.
The forest is fitted on at most ``SAMPLE`` labelled findings, by a hash.

An unquoted value ends at white space, at the next assignment of a list or
query, or at a closing tag, and closing punctuation is not part of it.

Cases: null and empty texts have no candidates; a value that occurs more than
once in a text is judged at each of its places, and is secret if it is at any of
them (it counts as one candidate, and is learnt from at the place that labels it
a secret); labels of one kind only, or none, leave the label rules in force; repeated rows are judged alike.
A secret goes everywhere in its text, one of under 16 characters as a whole
word; dictionary words and values of under 4 characters go where they are assigned.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, materialise

SAMPLE, TREES, DEPTH, CUTOFF = 20_000, 20, 6, 0.5
#: A dictionary word occurs at least this often.
DICTIONARY_COUNT = 5
LONG_TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}"
#: Characters before a long token or key format that its features see.
CONTEXT = 48
#: Fixed formats of public key kinds, and words that go before secrets and before other tokens.
KEY_FORMAT = (r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])|sk_live_[A-Za-z0-9]{24,}+"
              r"|xox[abp]-[A-Za-z0-9-]{20,}+|AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-]))"
              r"|-----BEGIN (?:[A-Z0-9]++ )*?PRIVATE KEY(?: BLOCK)?-----(?:(?:\s|\\[rn])*+[A-Za-z-]++: [^\n]*+\n)*+(?:(?:\s|\\[rn])*+[A-Za-z0-9+/=]{16,}+)*+"
              r"(?:(?:\s|\\[rn])*+(?:[A-Za-z0-9+/=]++(?:\s|\\[rn])++)?-----END (?:[A-Z0-9]++ )*?PRIVATE KEY(?: BLOCK)?-----)?")
KEY_WORD = r"(?i)(secret|token|passwd|password|pwd|api[_-]?key|access[_-]?key|auth|bearer|credential)"
OTHER_WORD = r"(?i)(commit|sha-?[0-9]*|md5|hash|checksum|digest|uuid|version|isbn|card|invoice|order|build|revision)\W*$"
IDENTIFIER = r"(?i)^[0-9_+/-]+$|^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|^[0-9]{4}-[0-9]{2}-[0-9]{2}.*$"
#: What goes before an assigned value: a key word with what belongs to its name, and a sign. A name is tried
#: once, from its first character, however many key words it holds.
KEYED = r"(?:secret(?!ar)|token(?!i[sz])|passwd|password|pwd|api[_-]?key|access[_-]?key|auth(?!ors?(?![a-z]))|bearer|credential)"
SIGN = r"[\w-]*+\\?[\"']?(?:\s*+(?::=|=>|={1,3}|:)\s*+|>)(?:(?:bearer|basic|token)\s++)?"
ASSIGN = rf"(?i:(?<![\w-])(?>[\w-]*?{KEYED}){SIGN})"
#: The value, in quotes or as the docstring says; a key that follows is none.
VALUE = f"(?![\"']?(?i:{KEYED}{SIGN})|[\"']?[\\w-]++[\"']?:\\s)" + r"(?:\"[^\"\r\n]++\"|'[^'\r\n]++'|(?:(?!&[\w.-]+=|[,;]\s*+[\"']?[\w-]+[\"']?\s*+[:=]|</)\S)++)"
#: A URL up to its password.
URL = r"://[^\s/:@]*+:"
FEATURES = ["length", "digits", "uppers", "lowers", "hex", "changes", "pair_log", "covered", "path", "assigned", "key_word", "other_word", "quoted", "known_format"]


def assigned_value(match):
    """(value, before, assigned) of an assignment."""
    prefix = F.regexp_extract(match, "^" + ASSIGN, 0)
    rest = F.substring(match, F.length(prefix) + 1, F.length(match))
    closed = rest.rlike("^(\"[^\"]*\"|'[^']*')$")
    value = F.when(closed, F.substring(rest, F.lit(2), F.length(rest) - 2)).otherwise(F.ltrim(F.rtrim(rest, F.lit("\\\"'`)]}>,;.")), F.lit("\\\"'`")))
    return F.struct(value.alias("value"), F.concat(prefix, F.regexp_extract(rest, "^[\\\\\"']*", 0)).alias("before"), F.lit(True).alias("assigned"))


def url_password(match):
    prefix = F.regexp_extract(match, "^" + URL, 0)
    return F.struct(F.substring(match, F.length(prefix) + 1, F.length(match) - F.length(prefix) - 1).alias("value"), prefix.alias("before"), F.lit(True).alias("assigned"))


def candidates(docs: DataFrame) -> DataFrame:
    """row, doc_id, digest (of the text), found (distinct values and texts before them, and whether they
    are assigned); written to the shared folder."""
    def every(pattern):
        return F.regexp_extract_all("text", F.lit(pattern), F.lit(0))

    def places(p):
        """Every match with the ``CONTEXT`` characters before it, from columns that hold one pattern's matches,
        the texts between them and the tails of both: each is made once for a text, not for every match."""
        return F.transform(f"{p}_m", lambda v, k: F.struct(v.alias("value"), F.right(F.concat_ws("", *(
            F.get(f"{p}_t", k - d) for d in (3, 2, 1)), F.get(f"{p}_b", k)), F.lit(CONTEXT)).alias("before"), F.lit(False).alias("assigned")))

    patterns = {"key": KEY_FORMAT, "long": LONG_TOKEN}
    rows = id_and_text(docs).withColumn("digest", F.md5("text"))
    for p, pattern in patterns.items():
        rows = rows.withColumn(f"{p}_m", every(pattern)).withColumn(f"{p}_b", F.split("text", pattern, -1))
        # Matches are of 16 characters or more: the three before reach back far enough.
        rows = rows.withColumn(f"{p}_t", F.transform(f"{p}_b", lambda s, k: F.right(F.concat(  # noqa: B023
            F.right(s, F.lit(CONTEXT)), F.coalesce(F.get(f"{p}_m", k), F.lit(""))), F.lit(CONTEXT))))
    found = F.concat(F.transform(F.array_distinct(every(ASSIGN + VALUE)), assigned_value),
                     F.transform(F.array_distinct(every(URL + r"[^\s/]+@")), url_password), *map(places, patterns))
    rows = rows.select("doc_id", "digest", F.array_distinct(F.filter(found, lambda x: x.value != "")).alias("found"))
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "secret-candidates")


def corpus_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the corpus's words of letters, lower-cased."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]++"), F.lit(0)))
    return id_and_text(docs).select(words.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= DICTIONARY_COUNT)


def letter_pairs(words: DataFrame) -> DataFrame:
    """(pair, log probability of its second letter after its first): 676 rows at most."""
    spots = F.explode(F.sequence(F.lit(1), F.length("word") - 1))
    pairs = words.filter(F.length("word") > 1).select("word", "n", spots.alias("k")) \
        .groupBy(F.expr("substring(word, k, 2)").alias("pair")).agg(F.sum("n").alias("n"))
    total = pairs.groupBy(F.substring("pair", 1, 1).alias("first")).agg(F.sum("n").alias("total"))
    return pairs.join(total, F.substring("pair", 1, 1) == F.col("first")).select("pair", F.log(F.col("n") / F.col("total")).alias("pair_log"))


def features(found: DataFrame, docs: DataFrame) -> DataFrame:
    """row, doc_id, digest, value and FEATURES of every candidate at every place."""
    at = found.select("row", "doc_id", "digest", F.explode("found").alias("f"))
    at = materialise(at.select("row", "doc_id", "digest", "f.value", "f.before", F.col("f.assigned").alias("named")), "secret-findings")
    v, n = F.col("value"), F.length("value")
    share = lambda p: F.regexp_count("value", F.lit(p)) / n
    assigned = F.col("before").rlike(KEY_WORD.replace("(?i)", "(?i)\\b\\w*") + r"\w*[\"']?\s*(:|=|:=|=>)\s*[\"']?$")
    basic = at.withColumns({
        "length": n.cast("double"), "digits": share("[0-9]"), "uppers": share("[A-Z]"), "lowers": share("[a-z]"),
        "hex": v.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "changes": share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "path": (F.regexp_count("value", F.lit("/")) + F.col("before").rlike(r"[./~\\]$").cast("int")).cast("double"),
        "assigned": (assigned | F.col("named")).cast("double"), "key_word": F.col("before").rlike(KEY_WORD).cast("double"),
        "other_word": F.col("before").rlike(OTHER_WORD).cast("double"), "quoted": F.col("before").rlike("[\"']$").cast("double"),
        "known_format": v.rlike(f"^(?:{KEY_FORMAT})$").cast("double")})
    words = materialise(corpus_words(docs), "secret-dictionary")
    # Letter pairs and letter runs of each distinct value, once.
    values = at.select("value").distinct()
    pair = values.filter(F.length("value") > 1).select("value", F.explode(F.sequence(F.lit(1), F.length("value") - 1)).alias("k")).select("value", F.lower(F.expr("substring(value, k, 2)")).alias("pair"))
    usual = pair.filter(F.col("pair").rlike("^[a-z]{2}$")).join(F.broadcast(letter_pairs(words)), "pair", "left") \
        .groupBy("value").agg(F.avg(F.coalesce("pair_log", F.lit(-12.0))).alias("pair_log"))
    runs = values.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    covered = runs.join(words.select("word"), "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    return basic.join(usual, "value", "left").join(covered, "value", "left") \
        .withColumn("pair_log", F.coalesce("pair_log", F.lit(-12.0))).withColumn("covered", F.coalesce(F.col("covered") / n, F.lit(0.0)))


def rule_labels(findings: DataFrame) -> DataFrame:
    """The findings with ``label``: 1 secret, 0 none, null where no rule decides."""
    # Without quotes, words of the corpus and expressions of code may stand after a key word, too.
    plain = (F.col("quoted") == 0) & ((F.col("covered") >= 0.6) | F.col("value").rlike(r"[(\[{$]")) & ~F.col("before").rlike(URL + "$")
    yes = (F.col("known_format") == 1) | ((F.col("assigned") == 1) & ~F.col("value").rlike(IDENTIFIER) & ~plain)
    no = F.col("value").rlike(IDENTIFIER) | (F.col("other_word") == 1) | (F.col("covered") >= 0.6) | (F.col("path") >= 3)
    return findings.withColumn("label", F.when(yes, 1.0).when(no, 0.0))


def by_value(judged: DataFrame) -> DataFrame:
    """One row for each value of a document: that of the place which is most a secret."""
    best = F.max(F.struct("secret", "score", "label", *FEATURES)).alias("x")
    return judged.groupBy("row", "doc_id", "digest", "value").agg(best).select("row", "doc_id", "digest", "value", "x.*")


def judge(docs: DataFrame, labelled: DataFrame | None = None, cutoff: float = CUTOFF) -> tuple[DataFrame, DataFrame]:
    """(candidates, findings with score and secret). ``labelled``: (value, label) rows to train from."""
    found = candidates(docs)
    rows = rule_labels(features(found, docs))
    if labelled is not None:
        marks = labelled.filter("value is not null and label in (0, 1)").groupBy("value").agg(F.max(F.col("label").cast("double")).alias("mark"))
        rows = rows.join(marks, "value", "left").withColumn("label", F.col("mark")).drop("mark")
    rows = materialise(rows, "secret-features")
    one = rows.filter("label is not null").groupBy("value").agg(F.max(F.struct("label", *FEATURES)).alias("x"))
    sample = one.orderBy(F.xxhash64("value"), "value").select("x.*").limit(SAMPLE)
    sample = materialise(sample.select("label", *FEATURES), "secret-sample")
    kinds = sample.agg(F.min("label"), F.max("label")).first()
    if kinds[0] is None or kinds[0] == kinds[1]:
        return found, by_value(rows.withColumn("score", F.coalesce("label", F.lit(0.0))).withColumn("secret", F.col("score") >= cutoff))
    vector = VectorAssembler(inputCols=FEATURES, outputCol="vector")
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=11)
    # The copy has no training summary, whose session can't be sent to tasks once it has observed a query.
    model = forest.fit(vector.transform(sample)).copy()
    judged = model.transform(vector.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    return found, by_value(judged.withColumn("secret", (F.col("score") >= cutoff) | (F.col("known_format") == 1)))


def report(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, n_candidates, n_secrets, secrets_sha256 (of the sorted values), top_score."""
    found, judged = judge(docs, labelled)
    per_row = judged.groupBy("row").agg(F.count_if("secret").alias("n_secrets"), F.max("score").alias("top_score"),
                                        F.array_sort(F.collect_list(F.when(F.col("secret"), F.col("value")))).alias("values"))
    return found.select("row", "doc_id", F.size(F.array_distinct("found.value")).cast("bigint").alias("n_candidates")).join(per_row, "row", "left").select(
        "doc_id", "n_candidates", F.coalesce("n_secrets", F.lit(0)).alias("n_secrets"),
        F.sha2(F.coalesce(F.concat_ws(",", "values"), F.lit("")).cast("binary"), 256).alias("secrets_sha256"), F.coalesce("top_score", F.lit(0.0)).alias("top_score"))


def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with the values judged secret replaced by [SECRET]; n_chars, if there, follows."""
    _, judged = judge(docs, labelled)
    v = F.col("value")
    # Quoted for Java, a value that holds \E too.
    exact = F.concat(F.lit("\\Q"), F.replace(v, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    common = (F.length(v) < 4) | ((F.col("covered") >= 1) & v.rlike("^[A-Za-z]+$") & (F.length(v) < 16))
    pattern = F.when(common, F.concat(F.lit(f"((?:{ASSIGN}\\\\?[\"']?|{URL}))"), exact, F.lit("(?![A-Za-z0-9])"))) \
        .when(F.length(v) < 16, F.concat(F.lit("()(?<![A-Za-z0-9])"), exact, F.lit("(?![A-Za-z0-9])"))).otherwise(F.concat(F.lit("()"), exact))
    # By id and text: rows that share an id, or have none, keep their own secrets.
    secrets = judged.filter("secret").groupBy(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).agg(F.transform(
        F.sort_array(F.collect_set(F.struct(F.length(v).alias("n"), "value", pattern.alias("p"))), asc=False), lambda x: x.p).alias("__secrets"))  # longest first
    own = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.join(secrets, (own == F.col("__digest")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left")
    clean = F.aggregate("__secrets", F.col("text"), lambda t, p: F.regexp_replace(t, p, F.lit("$1[SECRET]")))
    rows = rows.withColumn("text", F.when(F.col("__secrets").isNull(), F.col("text")).otherwise(clean))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("__secrets").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return rows.select(*docs.columns)
