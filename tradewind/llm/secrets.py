"""Secret scans over an incremental blob ledger.

Every historical version of a document is addressed by the SHA-256 of its text. The ledger, a
Parquet folder, holds one row per scanned blob: the rules that were run on it (name and version)
and what they found. A scan runs only the pairs of blob and rule version the ledger does not
hold, each blob once however many rows have it, and findings are joined back to all rows.

Built-in expressions only. Addresses are shuffled, and for a scan the texts of one row per unseen
blob, keyed by row and blob, so that a blob with very many rows is not a hot key. Findings meet
their rows in a join on the blob, which Spark splits where one blob has many rows.
"""

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.sinks.shared import shared_dir


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group`` has ``least`` characters.

    ``needs`` must match wherever the pattern does; texts without it are passed by. ``plain`` says the
    same as the pattern to an engine that has no possessive repetitions.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    needs: "str | None" = None
    version: int = 1
    plain: "str | None" = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# fixed values: the three base rules
BASE_RULES = (
    Rule(
        "assign",
        "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=20, needs="AKIA[A-Z0-9]{16}"),
    Rule("hex", "[0-9a-f]+", least=24, needs="[0-9a-f]{24}"),
)


def _key(own: str, between: str, word: str) -> "tuple[str, str]":
    """(begin, whole) of a private key; ``own`` makes a repetition possessive.

    A possessive group is gone through in a loop, where a plain one costs a stack frame a line. No
    choice is lost by it: what may follow a repetition can't begin with what it repeats.
    """
    named = f"(?:{word} )*{own}PRIVATE KEY(?: BLOCK)?-----"
    begin = f"-----BEGIN {named}"
    # up to the END line; no five dashes lie between, so another key's BEGIN is not passed
    to_end = f"(?:{between})*{own}-----END {named}"
    # without END: header fields, base64 runs of at least 16 characters, so that prose is no key, and
    # a shorter last one that has a line to itself, follows a written-out line break or is padded
    cut = (
        f"(?:[\\s>]+{own}[A-Z][A-Za-z]*-[A-Z][A-Za-z]*: [^\\r\\n]*{own})*{own}"
        f"(?:[\\s\\\\>\"'#*|,]*{own}[A-Za-z0-9+/=]{{16,}}{own})*{own}"
        "(?:[\"',]*\\r?\\n[\\x20\\t>\"'#*|]*[A-Za-z0-9+/=]{1,15}[\"',]*(?:\\r?\\n|\\z)"
        "|(?:\\\\[nr])+[A-Za-z0-9+/=]{1,15}|\\x20[A-Za-z0-9+/]{1,15}={1,2})?"
    )
    return begin, f"{begin}(?:{to_end}|{cut})"


_KEY_BEGIN, _KEY = _key("+", "[^-]++|-(?!----)", "(?!PRIVATE KEY)[A-Z0-9]+")
# the same for engines without possessive repetitions
KEY_PLAIN = _key("", "[^-]+|-{1,4}[^-]", "[A-Z0-9]+")[1]
# kinds of the ledger's own
MORE_RULES = (
    Rule(
        "private_key",
        _KEY,
        needs=_KEY_BEGIN,
        version=3,
        plain=KEY_PLAIN,
    ),
    Rule("vcs_token", "gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE_RULES + MORE_RULES

SPAN = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("rule", T.StringType()),
        T.StructField("end", T.IntegerType()),
    ]
)
LEDGER = T.StructType(
    [
        T.StructField("blob", T.StringType()),
        T.StructField("rules", T.ArrayType(T.StringType())),
        T.StructField("found", T.ArrayType(SPAN)),
    ]
)
_NO_SPANS = "array<struct<start:int,rule:string,end:int>>"


def content_address(text: Column) -> Column:
    """SHA-256 of the text in lowercase hex; a null text is the empty one."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _places(text: Column, rule: Rule) -> Column:
    """Spans of a rule, in code points, for a text in which ``needs`` matches.

    ``split`` gives the pieces between the matches, ``regexp_extract_all`` the matches, both
    leftmost and not overlapping. The k-th match starts where its piece ends: at the lengths of
    k pieces and k - 1 matches. These are added up in blocks of about the square root of their
    number, and then block by block, as each step of a fold copies the list it extends.
    """
    pairs = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("piece"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("wanted"),
    )
    lengths = F.transform(
        pairs,
        lambda x: F.struct(
            F.length(x["piece"]).alias("before"),
            F.coalesce(F.length(x["match"]), F.lit(0)).alias("long"),
            (F.length(x["wanted"]) >= rule.least).alias("keep"),
        ),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_NO_SPANS).alias("spans"))

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(rule.name).alias("rule"), end.alias("end"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["before"]
        end = begin + x["long"]
        spans = F.when(x["keep"], F.concat(acc["spans"], F.array(span(begin, end))))
        return F.struct(end.alias("at"), spans.otherwise(acc["spans"]).alias("spans"))

    def join(acc: Column, block: Column) -> Column:
        moved = F.transform(
            block["spans"], lambda s: span(s["start"] + acc["at"], s["end"] + acc["at"])
        )
        return F.struct(
            (acc["at"] + block["at"]).alias("at"), F.concat(acc["spans"], moved).alias("spans")
        )

    def added(bound: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(bound))).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(bound) - 1) / width).cast("int")),
            lambda i: F.aggregate(F.slice(bound, i * width + 1, width), zero, step),
        )
        return F.aggregate(blocks, zero, join, lambda acc: acc["spans"])

    # the lambda binds the list, which is never empty
    return F.transform(F.array(lengths), added)[0]


def rule_spans(text: Column, rule: Rule) -> Column:
    """What a rule finds in a text: array of (start, rule, end), by start."""
    return F.when(text.rlike(rule.needs or rule.pattern), _places(text, rule)).otherwise(
        F.array().cast(_NO_SPANS)
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per scanned blob: rules run so far and everything they found.

    A blob has one row in the folder for each scan that ran a new rule on it, so the groups have
    at most as many rows as there were rule versions.
    """
    rows = spark.read.schema(LEDGER).parquet(ledger)
    scans = rows.groupBy("blob").agg(F.collect_list(F.struct("rules", "found")).alias("scans"))

    def new(scan: Column, i: Column) -> Column:
        """What a scan found by rules that no scan before it ran, should one have been repeated."""
        earlier = F.flatten(F.slice("scans.rules", F.lit(1), i))
        return F.filter(scan["found"], lambda s: ~F.array_contains(earlier, s["rule"]))

    return scans.select(
        "blob",
        F.array_distinct(F.flatten("scans.rules")).alias("rules"),
        F.flatten(F.transform("scans", new)).alias("found"),
    )


def start_ledger(spark: SparkSession, ledger: str) -> None:
    """An empty ledger, where there is none yet."""
    none = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in LEDGER])
    none.write.mode("ignore").parquet(ledger)


def address(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, blob`` of every row, written once to the shared folder."""
    spark = docs.sparkSession
    place = shared_dir(spark, "secrets-addresses")
    docs.select(F.col(key).alias("key"), content_address(F.col(text)).alias("blob")).write.parquet(
        place
    )
    return spark.read.parquet(place)


def scan_unseen(
    docs: DataFrame,
    addresses: DataFrame,
    ledger: str,
    rules: "tuple[Rule, ...]" = RULES,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Append to the ledger what it lacks: unseen pairs of blob and rule version, each run once.

    The ledger has one writer. An append that fails leaves it as it was and can be repeated. Rows
    with one key and one text count as one.
    """
    spark = docs.sparkSession
    names = F.array(*[F.lit(r.name) for r in rules])
    one = addresses.groupBy("blob").agg(
        # a struct orders by null first, so a row with a null key can stand for a blob too
        F.min(F.struct("key")).alias("row")
    )
    seen = read_ledger(spark, ledger).select(F.col("blob").alias("seen"), "rules")
    todo = (
        one.join(seen, F.col("blob") == F.col("seen"), "left")
        .withColumn(
            "missing",
            F.array_except(names, F.coalesce("rules", F.array().cast("array<string>"))),
        )
        .filter(F.size("missing") > 0)
        .select(F.col("row")["key"].alias("todo_key"), F.col("blob").alias("todo_blob"), "missing")
    )
    texts = docs.select(
        F.col(key).alias("key"),
        content_address(F.col(text)).alias("blob"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    unseen = texts.join(
        todo,
        F.col("key").eqNullSafe(F.col("todo_key")) & (F.col("blob") == F.col("todo_blob")),
    )
    found = reduce(
        lambda a, b: F.concat(a, b),
        [
            F.when(
                F.array_contains("missing", rule.name), rule_spans(F.col("text"), rule)
            ).otherwise(F.array().cast(_NO_SPANS))
            for rule in rules
        ],
    )
    unseen.select("blob", F.col("missing").alias("rules"), found.alias("found")).write.mode(
        "append"
    ).parquet(ledger)


def ordered_spans(found: Column, rules: "tuple[Rule, ...]") -> Column:
    """What the given rule versions found: (start, place, kind, end), by start and place of rule."""
    names = F.array(*[F.lit(r.name) for r in rules])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    wanted = F.filter(
        F.coalesce(found, F.array().cast(_NO_SPANS)),
        lambda s: F.array_contains(names, s["rule"]),
    )

    def ranked(s: Column) -> Column:
        place = F.array_position(names, s["rule"]).cast("int")
        return F.struct(
            s["start"].alias("start"),
            place.alias("place"),
            F.element_at(kinds, place).alias("kind"),
            s["end"].alias("end"),
        )

    return F.array_sort(F.transform(wanted, ranked))


def find_secrets(
    docs: DataFrame,
    rules: "tuple[Rule, ...]" = RULES,
    key: str = "doc_id",
    text: str = "text",
    ledger: "str | None" = None,
) -> DataFrame:
    """``key, blob, found`` for every row of ``docs``; ``found`` lists all spans in order.

    Without ``ledger`` the call begins a new one in the shared folder. Null and empty texts are
    the blob of the empty text, which has no spans. Repeated rows come back repeated. A rule that
    was changed needs a new version: all blobs are then scanned with it, and findings of the older
    version stay in the ledger but are not given.
    """
    spark = docs.sparkSession
    ledger = ledger or shared_dir(spark, "secrets-ledger")
    start_ledger(spark, ledger)
    addresses = address(docs, key, text)
    scan_unseen(docs, addresses, ledger, rules, key, text)
    place = shared_dir(spark, "secrets-found")
    read_ledger(spark, ledger).filter(F.size("found") > 0).write.parquet(place)
    known = spark.read.parquet(place).select(F.col("blob").alias("known"), "found")
    return addresses.join(known, F.col("blob") == F.col("known"), "left").select(F.col("key").alias(key), "blob", ordered_spans(F.col("found"), rules).alias("found"))


def redact(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets; ``n_chars`` follows.

    ``found`` is what ``find_secrets`` gives for ``docs``. Overlapping spans are replaced as one,
    under the kind of the first. Only rows with a span join: findings have one row per blob.
    Every row stays; null texts stay null.
    """
    own = uuid.uuid4().hex[:8]
    blob, spans = f"_blob_{own}", f"_found_{own}"
    hits = (
        found.filter(F.size("found") > 0)
        .groupBy(F.col("blob").alias(blob))
        .agg(F.any_value("found").alias(spans))
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    text = docs["text"]

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = text.substr(acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(
            F.when(fresh, F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]")))
            .otherwise(acc["out"])
            .alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    cleaned = F.aggregate(
        spans,
        start,
        step,
        lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text) - acc["at"])),
    )
    clean = F.col(spans).isNull()
    changed = {"text": F.when(clean, text).otherwise(cleaned)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length(changed["text"]).cast(kind)
        changed["n_chars"] = F.when(clean, docs["n_chars"]).otherwise(length)
    joined = docs.join(hits, content_address(text) == F.col(blob), "left")
    return joined.select(*[changed.get(c, docs[c]).alias(c) for c in docs.columns])
