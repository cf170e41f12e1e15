"""Secret scans that link the parts of a credential.

Strong patterns are reported wherever they stand. Weak candidates (a user name, a long random string, an
endpoint) are common in harmless texts, so they are reported only next to the parts that complete them: a
random string with an access identifier in its scope, an identifier with a secret, an endpoint with both. The
scope is a number of code points around the candidate's start, within its text. The interval join works on
buckets as wide as the scope: parts are reduced to the first and last start per text, bucket and role, and a
candidate meets the buckets beside its own; so a text full of candidates costs their number, not its square.

Positions are code points, ends exclusive. A text is split at the matches of a pattern; adding up the lengths of
the pieces and the matches gives their places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from straitflow.llm.shared import attached, keyed, staged

#: The base patterns. Kinds are numbered in the order in which they are listed. A run of too few
#: characters never gives way to another match, so the least lengths of the last two stand in the patterns.
ASSIGN = "(?i)(?:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
LEAST_VALUE = 6

#: Weak candidates: identifiers, random strings with upper case, lower case and digits, endpoints.
WEAK_ACCESS = (
    "(?i)\\b(?:user(?:name)?|login|client_?id|account|access_?key_?id)[\"']?"
    "\\x20*[:=]\\x20*[\"']?[A-Za-z0-9._@-]{3,}"
)
WEAK_SECRET = (
    "(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9A-Z+/_-]*[a-z])(?=[0-9a-z+/_-]*[A-Z])[A-Za-z0-9+/_-]{32,}"
)
ENDPOINT = (
    "(?i)\\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\\s\"'<>]+"
    "|\\b(?:host|endpoint)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9.-]{4,}"
)

KINDS = {
    "assign": ASSIGN,
    "access": ACCESS,
    "hex": HEX,
    "linked_access": WEAK_ACCESS,
    "linked_secret": WEAK_SECRET,
    "linked_endpoint": ENDPOINT,
}
BASE_KINDS = 3
#: Which part of a credential each kind is: an access identifier, a secret, an endpoint.
ROLES = ["S", "A", "S", "A", "S", "E"]

SCOPE = 200


def matches(texts: DataFrame) -> DataFrame:
    """doc_id, h, kind, start, end of every match, by kind leftmost and not overlapping, weak candidates included.

    `texts` has doc_id, h (a hash of the text) and text. Rows with equal id and text give their matches once.
    """
    found = []
    for k, (name, pattern) in enumerate(KINDS.items()):
        whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        value = F.regexp_extract_all("text", F.lit(pattern), F.lit(1)) if name == "assign" else whole
        parts = F.arrays_zip(F.split("text", pattern, -1).alias("piece"), whole.alias("whole"), value.alias("value"))
        lengths = F.transform(
            parts,
            lambda x: F.struct(
                F.char_length(x["piece"]).alias("piece"),
                F.char_length(x["whole"]).alias("whole"),
                F.char_length(x["value"]).alias("value"),
            ),
        )
        found.append(F.when(F.col("text").rlike(pattern), F.struct(F.lit(k).alias("kind"), lengths.alias("parts"))))
    by_kind = texts.select("doc_id", "h", F.explode(F.array_compact(F.array(*found))).alias("m"))
    parts = by_kind.select("doc_id", "h", "m.kind", F.posexplode("m.parts").alias("k", "part")).distinct()
    ahead = Window.partitionBy("doc_id", "h", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    step = F.col("part.piece").cast("long") + F.coalesce("part.whole", F.lit(0))
    start = F.coalesce(F.sum(step).over(ahead), F.lit(0).cast("long")) + F.col("part.piece")
    placed = parts.select(
        "doc_id", "h", "kind", start.alias("start"), F.col("part.whole").alias("n"), F.col("part.value").alias("value")
    )
    long_enough = F.col("n").isNotNull() & ((F.col("kind") != 0) | (F.col("value") >= LEAST_VALUE))
    return placed.where(long_enough).select("doc_id", "h", "kind", "start", (F.col("start") + F.col("n")).alias("end"))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The base matches, and the weak ones whose complementary parts start within the scope.

    Weak matches that begin inside a base match are part of it, and are no candidates.
    """
    order = Window.partitionBy("doc_id", "h").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    covered_to = F.max(F.when(F.col("kind") < BASE_KINDS, F.col("end"))).over(order)
    parts = (
        found.withColumn("covered", F.coalesce(covered_to > F.col("start"), F.lit(False)))
        .where((F.col("kind") < BASE_KINDS) | ~F.col("covered"))
        .drop("covered")
        .withColumn("role", F.element_at(F.array(*map(F.lit, ROLES)), F.col("kind") + 1))
        .withColumn("bucket", F.floor(F.col("start") / scope))
    )
    bounds = [
        f(F.when(F.col("role") == role, F.col("start"))).alias(f"{name}_{role}")
        for role in "AS"
        for name, f in (("first", F.min), ("last", F.max))
    ]
    beside = parts.where("role <> 'E'").groupBy("doc_id", "h", "bucket").agg(*bounds)
    weak = parts.where(F.col("kind") >= BASE_KINDS).select(
        "doc_id", "h", "kind", "start", "end", F.explode(F.expr("sequence(bucket - 1, bucket + 1)")).alias("bucket")
    )
    near = {
        role: F.coalesce(
            (F.col(f"first_{role}") <= F.col("w.start") + scope) & (F.col(f"last_{role}") >= F.col("w.start") - scope),
            F.lit(False),
        )
        for role in "AS"
    }
    met = (
        weak.alias("w")
        .join(
            beside.alias("b"),
            F.col("w.doc_id").eqNullSafe(F.col("b.doc_id"))
            & (F.col("w.h") == F.col("b.h"))
            & (F.col("w.bucket") == F.col("b.bucket")),
        )
        .groupBy("w.doc_id", "w.h", "w.kind", "w.start", "w.end")
        .agg(F.max(near["A"]).alias("a"), F.max(near["S"]).alias("s"))
    )
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("kind") + 1)
    complete = ((role == "A") & F.col("s")) | ((role == "S") & F.col("a")) | (F.col("a") & F.col("s"))
    names = ["doc_id", "h", "kind", "start", "end"]
    return parts.where(F.col("kind") < BASE_KINDS).select(*names).unionAll(met.where(complete).select(*names))


def spans_of(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, h and found, the spans in order, of the texts that have any."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    texts = texts.withColumn("h", F.xxhash64("text"))
    return (
        linked(staged(matches(texts)), scope)
        .groupBy("doc_id", "h")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    )


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id and found: the spans as array<struct<start, kind, end>>, in order; empty where there are none.

    Rows stay as they are, repeated ones and null ids too.
    """
    rows = keyed(docs).alias("t")
    out = rows.join(
        spans_of(docs, scope).alias("s"),
        F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("t.h") == F.col("s.h")),
        "left",
    )
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    return out.select("t.doc_id", F.coalesce("s.found", none).alias("found"))


def written(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ","
    )


def report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per document: matches of each base kind, a digest of the base spans, and all spans."""
    found = scan(docs, scope)
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("found", lambda x: x["kind"] < BASE_KINDS)
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )


def redact(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """The text with every span replaced by the mark; spans that overlap are replaced together."""
    at = lambda n: n.cast("int")
    done = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(
                x["start"] >= s["at"],
                F.concat(s["out"], F.substring(text, at(s["at"] + 1), at(x["start"] - s["at"])), F.lit(mark)),
            )
            .otherwise(s["out"])
            .alias("out"),
        ),
    )
    rest = F.substring(text, at(done["at"] + 1), F.char_length(text))
    return F.when(F.size(spans) > 0, F.concat(done["out"], rest)).otherwise(text)


def redact_documents(docs: DataFrame, scope: int = SCOPE, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, text with its secrets replaced by a mark, and `carried`, a struct of the columns to carry.

    Null and empty texts stay as they are, and so do repeated rows.
    """
    rows = attached(keyed(docs, carry), staged(spans_of(docs, scope)))
    text = F.when(F.col("found").isNull(), F.col("text")).otherwise(redact(F.col("text"), F.col("found")))
    return rows.select("doc_id", text.alias("text"), "carried")
