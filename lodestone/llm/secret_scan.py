"""Secret scanning with built-in functions and a random forest that removes false positives.

Candidates are all values in a word (a run without white space) of these kinds, and their names:

* assigned: what follows a telling name and ``=``, ``:``, ``=>`` or ``:=``, in the same word (query strings, compact JSON) or as the next word.  A quoted
  value ends at its closing quote, another at the next ``&name=``, ``,name:`` or ``;name=``, or at the word's end without trailing marks;
* login: the password in ``scheme://user:password@host``;
* run: 16 or more key characters with a digit, whatever their name, that are not part of an assigned value.

Each has the words around it.  The forest judges length, character-class transitions, variety, common letter pairs, dictionary coverage,
path marks, and the words around.  It is fitted on labelled
findings: ``n_findings`` seeded cases of known kind (keys of several providers, tokens, passwords and passphrases in assignments; against them
commit and file hashes, identifiers, numbers, addresses, paths, variables, placeholders, plain words), made and measured by the same expressions.

No Python runs on the executors.  A text is scanned in its own row; only candidates are exploded.

Defined results: null and empty texts have no findings; a value found twice in a text is two findings; repeated rows are scanned alike; rows with a null
doc_id are scanned, with that doc_id; a probability of just ``threshold`` is accepted; extra columns are ignored; an
empty table gives no rows.  ``redact_secrets`` returns every document, and replaces each accepted value, wherever it stands in the document, by ``[SECRET]``.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.quality_rules import let, words_of
from lodestone.llm.shared import cut, fresh

KEY_RUN = r"[A-Za-z0-9+/_=\-]{16,}"
SECRET_NAME = r"[A-Za-z0-9_.\-]*(?i:passw|passphrase|pwd|secret|token|key|auth|bearer|credential)[A-Za-z0-9_.\-]*"
SIGN = r"[\"'`\]]*(?:=>|:=|=|:)"
TELLING = SECRET_NAME + SIGN + r".{4,}"
ASKING = SECRET_NAME + SIGN + r"[\"'`]?$"
LOGIN = r"://[^/:@]*:([^@/]+)@"
QUOTED = f"({SECRET_NAME}){SIGN}([\"'`])((?:(?!\\2).)+)\\2"
BARE = f"({SECRET_NAME}){SIGN}(?!//)([^\"'`=:][^\"'`]*?)(?=[&;,][A-Za-z_\"'][A-Za-z0-9_.\\-]*[\"'`]?[=:]|[\"'`]|$)"
UNCLOSED = f"({SECRET_NAME}){SIGN}[\"'`]([^\"'`]+)$"
RUN = r"(?:([A-Za-z][A-Za-z0-9_.\-]*)[\"'`]?(?:=>|:=|=|:)[\"'`]?)?((?!//)[A-Za-z0-9+/][A-Za-z0-9+/_.~\-]{15,}={0,2})"
GOOD_WORDS = r"(token|secret|passw|pwd|api|key|private|credential|auth|bearer|access)"
BAD_WORDS = r"(commit|sha|hash|md5|checksum|digest|uuid|guid|\bid\b|ref|version|build|example|sample|test|dummy|placeholder|order|invoice|card|phone|isbn|mail|etag|revision|integrity)"
PASSWORD_NAME = r"(passw|passphrase|pwd|secret)"
TEMPLATE = r"^[<$%{*#]|[>}*]$|\*{3}|\{\{|x{4}|\.env|environ|getenv|^(none|null|true|false|undefined)$"
PHRASE = r"^[A-Za-z]+([-_. ][A-Za-z]+){3,}$"
PROVIDER = r"^(AKIA|ASIA|ghp_|gho_|glpat-|sk_live_|sk-|xox[abp]-|AIza|eyJ|npm_|SG\.)"
DICTIONARY = r"(example|sample|test|user|name|data|file|image|index|page|http|https|www|com|net|org|html|json|get|set|from|with|value|key|token|your|here|placeholder|changeme|password|config|local|host|server|version|build|number|order|product|item|list|the|and|this|that|main|src|lib|bin|usr|home|var|docs|public|static|assets)"
PAIRS = r"(th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|hi|ri|ro|ic|ne|ra)"
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
FEATURES = (
    "length transitions digits upper lower distinct pairs covered hex numeric uuid provider slashes dots dashes extension "
    "named quoted assigned good_name good_near bad_name bad_near same_run symbols password_name template phrase login"
).split()


def asked(last: Column, previous: Column) -> Column:
    """Whether the words before (the last and the one before that) end in a telling name and a sign of assignment."""
    sign = last.rlike(r"^(=>|:=|=|:)$") & previous.rlike(SECRET_NAME + "[\"'`\\]]*$")
    return (last.endswith("=") | last.endswith(":") | last.endswith('"') | last.endswith(">")) & (last.rlike(ASKING) | sign)


def is_candidate(word: Column, last: Column, previous: Column) -> Column:
    """Whether a word holds candidates, given the two words before it."""
    long = (F.length(word) >= 12) & (word.rlike("[0-9]") | word.rlike("[=:]"))
    return (F.length(word) >= 6) & ((long & ((word.rlike(KEY_RUN) & word.rlike("[0-9]")) | word.rlike(TELLING) | word.rlike(LOGIN))) | asked(last, previous))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, word_no, word, before, after): each word with candidates, the three words before it and the word after it."""

    def pick(w: Column) -> Column:
        near = lambda i, k: F.coalesce(F.get(w, i + k), F.lit(""))
        spots = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: is_candidate(F.get(w, i), near(i, -1), near(i, -2)))
        row = lambda i: F.struct(
            i.alias("word_no"),
            F.get(w, i).alias("word"),
            F.concat_ws(" ", F.when(i > 2, near(i, -3)), F.when(i > 1, near(i, -2)), F.when(i > 0, near(i, -1))).alias("before"),
            near(i, 1).alias("after"),
        )
        return F.when(F.size(w) > 0, F.transform(spots, row))

    found = docs.select("doc_id", let(words_of(F.coalesce("text", F.lit(""))), pick).alias("found"))
    return found.where(F.size("found") > 0).select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.*")


def values_of(word: Column, before: Column) -> Column:
    """(kind, name, value) of all candidates in a word."""
    last, previous = F.substring_index(before, " ", -1), F.substring_index(F.substring_index(before, " ", -2), " ", 1)

    def found(kind: str, pattern: str, name: int, value: int) -> Column:
        names = F.regexp_extract_all(word, F.lit(pattern), F.lit(name)) if name else F.transform(F.regexp_extract_all(word, F.lit(pattern), F.lit(value)), lambda _: F.lit(""))
        each = F.arrays_zip(names.alias("name"), F.regexp_extract_all(word, F.lit(pattern), F.lit(value)).alias("value"))
        return F.transform(each, lambda x: F.struct(F.lit(kind).alias("kind"), x["name"].alias("name"), x["value"].alias("value")))

    trim = lambda x, pattern: F.struct(x["kind"].alias("kind"), x["name"].alias("name"), F.regexp_replace(x["value"], pattern, "").alias("value"))
    bare = F.transform(F.concat(found("assigned", BARE, 1, 2), found("assigned", UNCLOSED, 1, 2)), lambda x: trim(x, r"(?<!=)(?!={1,2}$)[^A-Za-z0-9=]+$"))
    runs = F.transform(found("run", RUN, 1, 2), lambda x: trim(x, r"[.\-_/~]+$"))
    name = F.when(last.rlike(ASKING), last).otherwise(previous)
    whole = F.regexp_replace(F.regexp_replace(word, "^[\"'`({\\[]+", ""), "[^A-Za-z0-9=]+$", "")
    next_word = F.when(asked(last, previous) & ~word.rlike(TELLING), F.array(F.struct(F.lit("assigned").alias("kind"), F.regexp_extract(name, f"({SECRET_NAME})", 1).alias("name"), whole.alias("value"))))
    sure = F.array_distinct(F.concat(found("assigned", QUOTED, 1, 3), bare, found("login", LOGIN, 0, 1), F.coalesce(next_word, F.array().cast("array<struct<kind:string,name:string,value:string>>"))))

    def all_of(sure: Column) -> Column:
        return F.concat(sure, F.filter(F.array_distinct(runs), lambda r: ~F.exists(sure, lambda x: (F.length(x["value"]) >= 6) & F.contains(x["value"], r["value"]))))

    return let(sure, all_of)


def measure(found: DataFrame) -> DataFrame:
    """The candidates' values and the features of FEATURES, a row for each value."""
    valued = found.withColumn("x", F.explode(values_of(F.col("word"), F.col("before")))).select(*found.columns, "x.*").where(F.length("value") >= 6)
    v, low = F.col("value"), F.lower("value")
    n = F.length("value").cast("double")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    near = F.lower("before")
    flag = lambda c: c.cast("double")
    columns = {
        "length": n,
        "transitions": F.regexp_count(v, F.lit(r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])")) / n,
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
        "pairs": F.regexp_count(low, F.lit(PAIRS)) / n,
        "covered": 1 - F.length(F.regexp_replace(low, DICTIONARY, "")) / n,
        "hex": flag(low.rlike("^[0-9a-f]+$")),
        "numeric": flag(v.rlike(r"^[0-9.\-]+$")),
        "uuid": flag(v.rlike(UUID)),
        "provider": flag(v.rlike(PROVIDER)),
        "symbols": share(r"[^A-Za-z0-9+/_.=\-]"),
        "password_name": flag(F.lower("name").rlike(PASSWORD_NAME)),
        "template": flag(low.rlike(TEMPLATE)),
        "phrase": flag(v.rlike(PHRASE)),
        "login": flag(F.col("kind") == "login"),
        "slashes": share("/"),
        "dots": share(r"\."),
        "dashes": share("[-_]"),
        "extension": flag(low.rlike(r"\.[a-z]{2,4}$")),
        "named": flag(F.col("name") != ""),
        "quoted": flag(F.col("word").rlike("[\"'`]")),
        "assigned": flag((F.col("name") != "") | F.col("before").rlike("[=:]$")),
        "good_name": flag(F.lower("name").rlike(GOOD_WORDS)),
        "good_near": flag(near.rlike(GOOD_WORDS)),
        "bad_name": flag(F.lower("name").rlike(BAD_WORDS)),
        "bad_near": flag(near.rlike(BAD_WORDS) | F.lower("after").rlike(BAD_WORDS) | F.col("word").contains("@") | F.col("word").contains("://")),
        "same_run": flag(v.rlike(r"(.)\1{4,}|0123456|1234567|abcdef")),
    }
    return valued.select("*", *[columns[c].cast("double").alias(c) for c in FEATURES])


#: Choices a part of a made case is drawn from.
CHOICES = {
    "prose": ["the on of", "er and thion", "", "with en la", "que los de", "und der ein", "ouha. Ered the"],
    "tail": ["", "", ".", ",", "###", "%%%", "&&&", "$$$"],
    "secret_name": ["token", "TOKEN", "api_key", "apiKey", "secret", "client_secret", "password", "passwd", "access_key", "auth_token", "aws_secret_access_key", "private_key"],
    "plain_name": ["commit", "sha1", "md5", "checksum", "etag", "revision", "uuid", "id", "ref", "digest", "build", "order"],
    "word": ["threing", "andention", "produit", "kunden", "images", "reports", "main", "user", "article", "erthould"],
    "other": ["oning", "list", "index", "seite", "pages", "value", "data", "theration", "number"],
    "q": ['"', "'", ""],
    "eq": ["=", ":", "="],
    "password_word": ["password", "passwd", "pwd", "db_password", "PASSWORD", "userPassword", "passphrase", "secret"],
    "spaced": [":", "=", " =", " :"],
    "sign": ["=", ":"],
    "symbol": ["!", "#", "@", "$", "%", "^", "&", "*", "?", ";"],
    "joint": ["!", "#", "@", "-", "_", ".", "&", "+"],
    "leet": ["Tr0ub4dor", "p@ssw0rd", "hunter2", "S3cret", "Winter2024", "qwErty12", "dr4gon", "letM3in", "Blu3Sky", "n1ghtOwl"],
    **{f"lower{i}": ["correct", "horse", "battery", "staple", "river", "candle", "orange", "window", "monkey", "paper", "silver", "garden", "wolke", "berg", "maison", "rouge", "verde", "campo"] for i in range(4)},
    "dash": ["-", "-", "_", "."],
    "template": ["your_password_here", "<your-password>", "${DB_PASSWORD}", "{{password}}", "%(password)s", "********", "process.env.PASSWORD", "os.environ.get", "xxxxxxxx", "changeme", "undefined", "required", "[required]", "placeholder", "example-password", "$PASSWORD_HERE", "PASSWORD_HERE"],
    "dummy": ["your_api_key_here1", "example_token_123456", "xxxxxxxxxxxxxxxx", "placeholder_key_01", "changeme12345678", "<your-token-here>", "example-token-1234567", "0000000000000000000", "test_key_1234567890"],
    "usual": ["please", "should", "therefore", "wichtig", "important", "changed", "whenever", "musique", "nothing", "authentication", "configured", "rotation-policy", "well-known", "two-factor", "everyone's", "expires", "optional", "minimum-length"],
    "asked_word": ["password", "passwd", "secret", "key", "token", "Keyword", "the key", "author", "authors"],
    "weak_name": ["key", "token", "keywords", "author", "monkey", "auth"],
    "scheme": ["postgres", "mysql", "https", "amqp", "redis", "mongodb+srv"],
    "login": ["user", "admin", "app", ""],
    "host": ["db.example.com/main", "localhost:5432", "10.0.0.5/x", "host"],
    "more": ["", "&page=2", "&user=ann"],
    "field": ["id", "page", "ref", "sha"],
    "provider": ["ghp_", "sk_live_", "xoxb-", "glpat-", "npm_", "AIza"],
    "bearer": ["Authorization: Bearer", "bearer", "jwt ="],
    "cloud": ["AWS secret key", "access key:", "secret ="],
    "session": ["id", "uuid", "request", "", "session"],
    "number_name": ["id=", "order:", "", "no:"],
    "ending": [".html", ".json", ".png", ".txt"],
    "article": ["SKU-", "ABC-", "INV-"],
    "order_word": ["order", "invoice", "", "product"],
    "check_word": ["integrity", "integrity:", "digest"],
}
#: Parts that are one of several drawn from the parts above, given as templates.
MIXES = {
    "key": ["«hex32»", "«hex40»", "«hex18»", "«mixed24»", "«mixed40»", "«base40»", "«mixed32»"],
    "hash": ["«hex32»", "«hex40»", "«hex64»", "«hex40»"],
    "secret_password": ["«leet»«symbol»«mixed4»", "«leet»«mixed5»«symbol»«more5»", "«mixed6»«joint»«more5»", "«leet»«joint»«digits2»", "«mixed12»", "«mixed9»"],
    "plain": ["«usual»", "«lower0»", "«word»", "«other»"],
    "parameter": ["«digits8»", "«hash»", "«word»"],
    "passphrase": ["«lower0»«dash»«lower1»«dash»«lower2»«dash»«lower3»"],
}
#: (label, word, words before).
CASES = [
    (1, "«password_word»«sign»«q»«secret_password»«q»", "«prose»"),
    (1, "«q»«secret_password»«q»", "«prose» «password_word»«spaced»"),
    (1, "«q»«passphrase»«q»", "«prose» «password_word»«spaced»"),
    (1, "«password_word»«sign»«passphrase»", "«prose»"),
    (1, "«scheme»://«login»:«secret_password»@«host»", "«prose»"),
    (1, "https://api.example.com/v«digits1»?«secret_name»=«key»«more»", "«prose»"),
    (1, '{"user":"«word»«digits4»","«secret_name»":"«key»"}', "«prose»"),
    (1, "«q»«key»«q»«tail»", "«prose» «secret_name» «eq»"),
    (1, "«secret_name»«eq»«q»«key»«q»«tail»", "«prose»"),
    (1, "password=«hex18»«tail»", "«prose»"),
    (1, "AKIA«caps16»«tail»", "«prose»"),
    (1, "«provider»«mixed36»«tail»", "«prose»"),
    (1, "eyJ«mixed33».«more40».«last43»«tail»", "«prose» «bearer»"),
    (1, "«base40»«tail»", "«prose» «cloud»"),
    (1, '"«base40»"«tail»', "«prose» «cloud»"),
    (0, "«password_word»«sign»«q»«template»«q»", "«prose»"),
    (0, "«q»«template»«q»", "«prose» «password_word»«spaced»"),
    (0, "«plain»", "«prose» «asked_word»:"),
    (0, "«plain»", "«prose» «asked_word» :"),
    (0, "«weak_name»«sign»«plain»", "«prose»"),
    (0, "https://www.example.com/«word»?«field»=«parameter»", "«prose»"),
    (0, "https://www.example.com/«word»?«field»=«parameter»&lang=en", "«prose»"),
    (0, "http://«word»:«digits4»/«other»@«word»", "«prose»"),
    (0, '{"commit":"«hash»","«plain_name»":"«uuid»"}', "«prose»"),
    (0, "«hash»«tail»", "«prose» «plain_name»"),
    (0, "«plain_name»«eq»«q»«hash»«q»«tail»", "«prose»"),
    (0, "«hash»«tail»", "«prose»"),
    (0, "«uuid»«tail»", "«prose» «session»"),
    (0, "«digits16»«tail»", "«prose»"),
    (0, "«number_name»«digits18»«tail»", "«prose»"),
    (0, "«word».«digits2»@mail«digits1».example.com«tail»", "«prose»"),
    (0, "https://www.example.org/«word»/«digits6»/«other»-«word»«tail»", "«prose»"),
    (0, "/usr/«word»/«other»«digits3»/«word»«ending»«tail»", "«prose»"),
    (0, "«word»_«other»_from_«word»«digits2»«tail»", "«prose»"),
    (0, "20«digits2»-«digits2»-«digits2»T«digits2»:«digits2»:«digits2»", "«prose»"),
    (0, "«secret_name»«eq»«q»«dummy»«q»", "«prose»"),
    (0, "«q»«dummy»«q»", "«prose» «secret_name» «eq»"),
    (0, "«article»«digits4»-«digits6»-«caps4»«tail»", "«prose» «order_word»"),
    (0, "«word»-«other»-«word»-«digits2»«tail»", "«prose»"),
    (0, "sha256-«base43»=", "«prose» «check_word»"),
    (0, "«digits3».«digits2».«digits3».«digits2»:«digits4»«tail»", "«prose»"),
]
PART = re.compile("«([a-z_]+?)([0-9]*)»")


def labelled_findings(spark: SparkSession, n_findings: int, seed: int = 5) -> DataFrame:
    """Seeded cases (word, before, after, label): templates filled with seeded parts by built-in functions, so they are the same everywhere."""
    mark = lambda k: F.sha2(F.concat_ws("/", F.lit(str(seed)), F.col("id"), F.lit(k)), 256)
    mixed = lambda k: F.regexp_replace(F.base64(F.unhex(F.concat(mark(k), mark(k + "2")))), "[+/=]", "x")
    runs = {
        "hex": mark("h"),
        "caps": F.translate(mark("c"), "0123456789abcdef", "Q7RZTN6HKJ5AMX2W"),
        "mixed": mixed("m"),
        "more": mixed("m3"),
        "last": mixed("m4"),
        "base": F.base64(F.unhex(F.concat(mark("b"), mark("b2")))),
        "digits": F.regexp_replace(F.translate(mark("d"), "abcdef", "123456"), "^0", "4"),
    }
    one_of = lambda k, x: F.element_at(F.array(*[F.lit(i) for i in x]), (F.pmod(F.xxhash64(F.lit(seed), "id", F.lit(k)), F.lit(len(x))) + 1).cast("int"))
    parts = {**{f"run_{k}": c for k, c in runs.items()}, **{f"part_{k}": one_of(k, x) for k, x in CHOICES.items()}}
    parts["part_uuid"] = F.regexp_replace(F.substring(mark("u"), 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    rows = cut(spark.range(0, n_findings, 1, 4).select("id", *[c.alias(k) for k, c in parts.items()]))  # steps, so that each has a small plan

    def filled(template: Column, texts: list[str]) -> Column:
        for name, size in sorted({m.groups() for t in texts for m in PART.finditer(t)}):
            whole = name + size
            part = F.col(f"part_{whole}") if f"part_{whole}" in known else F.substring(f"run_{name}", 1, int(size))
            template = F.replace(template, F.lit(f"«{whole}»"), part)
        return template

    known = set(parts)
    for name, texts in MIXES.items():
        rows = rows.withColumn(f"part_{name}", filled(one_of(name, texts), texts))
        known.add(f"part_{name}")
    rows = cut(rows)
    case = (F.pmod("id", F.lit(len(CASES))) + 1).cast("int")
    column = lambda i: F.element_at(F.array(*[F.lit(c[i]) for c in CASES]), case)
    made = rows.select(*[filled(column(i), [c[i] for c in CASES]).alias(n) for i, n in ((1, "word"), (2, "before"))], F.lit("").alias("after"), column(0).cast("double").alias("label"))
    last, previous = F.substring_index("before", " ", -1), F.substring_index(F.substring_index("before", " ", -2), " ", 1)
    return made.where(is_candidate(F.col("word"), last, previous))


def fit_forest(spark: SparkSession, n_findings: int = 9600, trees: int = 32, depth: int = 9, seed: int = 7) -> RandomForestClassificationModel:
    """Fitted on ``n_findings`` made cases; a bare run beside an assigned or login value of the same word is not the secret."""
    cases = cut(measure(cut(labelled_findings(spark, n_findings))))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(cases).withColumn("label", F.expr(true_label()))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label").fit(rows.select("features", "label"))


def true_label() -> str:
    return r"if(kind = 'run' AND word RLIKE '[?]|:[^/:@]+@|[{]', 0D, label)"


def scan_secrets(docs: DataFrame, model: RandomForestClassificationModel | None = None, threshold: float = 0.5) -> DataFrame:
    """Accepted findings: doc_id, word_no (from 0), value, name, probability."""
    model = model or fit_forest(docs.sparkSession)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(measure(candidates(docs)))
    judged = model.transform(rows).withColumn("p", F.element_at(vector_to_array("probability"), 2))
    return judged.where(F.col("p") >= threshold).select("doc_id", "word_no", "value", "name", F.round("p", 6).alias("probability"))


def redact_secrets(docs: DataFrame, model: RandomForestClassificationModel | None = None, text: str = "text") -> DataFrame:
    """All documents; accepted values are replaced by [SECRET], longest first, and n_chars follows the text."""
    key, found = fresh(docs, "found_id"), fresh(docs, "found_values")
    values = scan_secrets(docs, model).groupBy(F.col("doc_id").alias(key)).agg(F.collect_set("value").alias("v"))
    longest_first = F.expr("transform(array_sort(transform(v, x -> struct(-length(x) AS n, x AS x))), y -> y.x)")
    joined = docs.join(values.select(key, longest_first.alias(found)), F.col("doc_id").eqNullSafe(F.col(key)), "left")
    clean = F.aggregate(found, F.col(text), lambda t, v: F.replace(t, v, F.lit("[SECRET]")))
    same = F.col(found).isNull()
    out = joined.withColumn(text, F.when(same, F.col(text)).otherwise(clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length(text).cast(dict(docs.dtypes)["n_chars"])))
    return out.select(*docs.columns)
