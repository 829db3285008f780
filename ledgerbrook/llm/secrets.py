r"""Secret scans with linking of credentials that come in parts.

Base spans stand for themselves: assignments of a value to a telling name, access
identifiers, long runs of hexadecimal digits. Weak candidates say nothing alone:
a long token of mixed letters and digits (the other half of an access identifier),
a user name that is assigned, the address of an endpoint. An interval join brings
together the parts of one document whose distance is at most ``scope`` code
points; a weak candidate becomes a span only if it complements another part:

* a weak secret beside an access identifier, a user name or an endpoint,
* a user name beside an assignment or a weak secret,
* an endpoint beside a secret (an assignment, a weak secret) and an identifier.

Parts are put in buckets of one scope, a candidate into all that its span touches, a
partner into all that its span touches with one scope on both sides, and the join
only asks whether a partner exists, so a text full of parts makes no pairs. All of it is DataFrame functions.

Defined cases: a null text is empty and has no spans. Positions count code points,
ends are exclusive. A weak candidate that overlaps a base span is that span already and is
dropped. Repeated rows get the same spans each. A null doc_id is kept. Extra
columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import keep, let, whole_row

SCOPE = 200

#: The base patterns, with the shortest match (or group 2) that counts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGNED_LENGTH = 12
BASE = ("assign", "access", "hex")

WEAK_SECRET = (
    r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])"
    r"[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/=_-])"
)
WEAK_USER = r"""(?i)\b(?:user(?:_?name)?|login|client_?id|account)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9@._-]{3,}+"""
WEAK_ENDPOINT = r"(?i)\b(?:https?|jdbc:[a-z0-9]{2,}+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D\"'<>|]{4,}+"
WEAK = {"weak_secret": WEAK_SECRET, "user": WEAK_USER, "endpoint": WEAK_ENDPOINT}

_SPAN = "struct<kind:string,start:int,end:int>"


def _matches(text: Column, pattern: str, kind: str, least: int = 0) -> Column:
    """Spans of all matches, leftmost and without overlap, from the pieces between them."""

    def located(found: Column) -> Column:
        def placed(between: Column) -> Column:
            step = F.transform(found, lambda m, i: F.struct((F.length(between[i]) + F.length(m)).alias("far"), F.length(m).alias("own")))
            first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))
            return F.aggregate(
                step,
                first,
                lambda acc, x: F.struct(
                    (acc["at"] + x["far"]).alias("at"),
                    F.concat(
                        acc["spans"],
                        F.array(
                            F.struct(
                                F.lit(kind).alias("kind"),
                                (acc["at"] + x["far"] - x["own"]).alias("start"),
                                (acc["at"] + x["far"]).alias("end"),
                            )
                        ),
                    ).alias("spans"),
                ),
                lambda acc: acc["spans"],
            )

        return let(F.split(text, pattern), placed)

    none = F.array().cast(f"array<{_SPAN}>")
    spans = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)
    if least:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        spans = let(values, lambda v: F.filter(spans, lambda s, i: F.length(v[i]) >= least))
    return F.when(text.rlike(pattern), spans).otherwise(none)


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _ordered(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Spans by start, then by kind in the order given."""
    place = lambda s: F.array_position(F.array(*map(F.lit, kinds)), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), place(s).alias("b"), s["end"].alias("c"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def base_spans(text: Column) -> Column:
    return F.concat(
        _matches(text, ASSIGN, "assign", ASSIGNED_LENGTH), _matches(text, ACCESS, "access"), _matches(text, HEX, "hex")
    )


def _weak_spans(text: Column, base: Column) -> Column:
    weak = F.concat(*(_matches(text, pattern, kind) for kind, pattern in WEAK.items()))
    clash = lambda w, b: (w["start"] < b["end"]) & (b["start"] < w["end"])
    return let(weak, lambda found: F.filter(found, lambda w: ~F.exists(base, lambda b: clash(w, b))))


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """The weak parts (doc_key, kind, start, end) that complementary parts confirm."""
    weak = parts.where(F.col("kind").isin(*WEAK)).select("doc_key", "kind", "start", "end")

    def near(rows: DataFrame, *kinds: str) -> DataFrame:
        partners = parts.where(F.col("kind").isin(*kinds)).select(
            F.col("doc_key").alias("k"),
            F.col("start").alias("s"),
            F.col("end").alias("e"),
            # every bucket that a candidate within the scope can touch
            F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))).alias("b"),
        )
        touched = F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))
        close = (F.col("s") <= F.col("end") + scope) & (F.col("start") <= F.col("e") + scope)
        met = (F.col("doc_key") == F.col("k")) & (F.col("bucket") == F.col("b")) & close
        return rows.withColumn("bucket", F.explode(touched)).join(partners, met, "left_semi").drop("bucket").distinct()

    of = lambda kind: weak.where(F.col("kind") == kind)
    secrets = near(of("weak_secret"), "access", "user", "endpoint")
    users = near(of("user"), "assign", "weak_secret")
    endpoints = near(near(of("endpoint"), "assign", "weak_secret"), "access", "user")
    return secrets.union(users).union(endpoints).select("doc_key", "kind", "start", "end")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_key, base (spans), spans (base and linked weak ones)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"))
    key = F.xxhash64("doc_id", "text").alias("doc_key")
    found = keyed.select("doc_id", key, "text", base_spans(F.col("text")).alias("base"))
    found = found.select("doc_id", "doc_key", "base", _weak_spans(F.col("text"), F.col("base")).alias("weak"))
    found = keep(found, "secrets")
    some = found.where(F.size("weak") > 0).dropDuplicates(["doc_key"])
    parts = some.select("doc_key", F.explode(F.concat("base", "weak")).alias("p")).select("doc_key", "p.*")
    links = _linked(keep(parts, "secret-parts"), scope)
    lists = links.groupBy("doc_key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("linked"))
    none = F.array().cast(f"array<{_SPAN}>")
    kinds = (*BASE, *WEAK)
    out = found.join(lists, "doc_key", "left")
    return out.select(
        "doc_id",
        "doc_key",
        _ordered(F.col("base"), BASE).alias("base"),
        _ordered(F.concat("base", F.coalesce("linked", none)), kinds).alias("spans"),
    )


def report(found: DataFrame) -> DataFrame:
    """The digest of ``scan`` per document: counts by base kind, hash of the base spans, all spans."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"),
        _text_of(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[REDACTED]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; n_chars follows; nothing else changes."""
    key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    hits = scan(docs, scope).where(F.size("spans") > 0).dropDuplicates(["doc_key"])
    hits = hits.select(F.col("doc_key").alias("key"), "spans")

    def cleaned(text: Column, spans: Column) -> Column:
        first = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

        def step(acc: Column, s: Column) -> Column:
            gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
            fresh = F.when(s["start"] >= acc["at"], F.concat(gap, F.lit(mark))).otherwise(F.lit(""))
            return F.struct(F.concat(acc["out"], fresh).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

        rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
        return F.aggregate(spans, first, step, rest)

    out = docs.select(whole_row(docs), "text", key.alias("key")).join(hits, "key", "left")
    hit = F.col("spans").isNotNull()
    out = out.withColumn("text", F.when(hit, cleaned(F.col("text"), F.col("spans"))).otherwise(F.col("text")))
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        row = row.withField("n_chars", F.when(hit, F.length("text").cast(kind)).otherwise(F.col("row.n_chars")))
    return out.select(row.alias("row")).select("row.*")
