"""Secret scan with multipart credential linking, on DataFrame functions alone.

Base kinds are reported wherever they match: ``assign`` (a credential name given a value of 6 or more
characters), ``access`` (an access identifier of 20 or more characters) and ``hex`` (24 or more hex
digits). Weak candidates say little alone and are reported only when complementary parts co-occur
within ``scope`` code points:

    ident      an account or client identifier             with a secret part
    key        a bare 40-character key                     with an identifier part
    endpoint   a URL's scheme, host and port               with an identifier and a secret part

where identifier parts are access and ident spans, secret parts are assign, hex and key spans, and a
span lies in the scope of another if their starts are at most ``scope`` apart.

Linking is an interval join of rows (document, bucket of ``scope`` code points): a candidate looks at its
own bucket and the two beside it, each reduced to its first and last start per role, so the work is
linear in the number of spans however many a document holds.

Defined results: null text is empty and has no spans; repeated rows are each reported; an empty table
gives no rows; offsets are code points with the end exclusive; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

#: The base kinds and their patterns (letters of names in either case).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Weak candidates.
IDENT = r"(?<![A-Za-z0-9_])(?i:client_?id|account_?id|access_?key_?id|username|user)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{4,64}"
KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9.-]+(?::[0-9]{2,5})?"

KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
SCOPE = 200
#: Running sums are made in blocks of so many matches, and then over the blocks.
_BLOCK = 64


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + x)


def spans(text: Column, pattern: str, kind: str, keep, group: int | None = None) -> Column:
    """array<struct<start, kind, end>> of a pattern's leftmost non-overlapping matches that ``keep``
    (a predicate of the match, or of the named group) lets through.

    The text between matches is what ``split`` gives; a match starts after all gaps up to it and all
    earlier matches. The sums are taken by blocks, so long lists of matches stay cheap.
    """
    length = lambda x: F.char_length(x).cast("long")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tested = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    each = F.zip_with(
        F.zip_with(gaps, found, lambda g, m: F.struct(length(g).alias("gap"), length(m).alias("size"))),
        tested,
        lambda s, t: F.struct(s.gap.alias("gap"), s.size.alias("size"), keep(t).alias("keep")),
    )
    blocks = F.transform(F.sequence(F.lit(1), F.size(found), F.lit(_BLOCK)), lambda b: F.slice(each, b, F.lit(_BLOCK)))
    placed = _placed(blocks)
    listed = F.filter(placed, lambda s: s.keep)
    out = F.transform(listed, lambda s: F.struct(s.start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (s.start + s.size).alias("end")))
    return F.when(F.regexp_like(text, F.lit(pattern)), out).otherwise(F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))


def _placed(blocks: Column) -> Column:
    advance = lambda block: _sum(F.transform(block, lambda s: s.gap + s.size))
    sums = F.transform(blocks, advance)
    before = F.transform(sums, lambda _, i: _sum(F.slice(sums, F.lit(1), i)))
    return F.flatten(
        F.zip_with(
            blocks,
            before,
            lambda block, start: F.transform(block, lambda s, i: F.struct((start + advance(F.slice(block, F.lit(1), i)) + s.gap).alias("start"), s.size.alias("size"), s.keep.alias("keep"))),
        )
    )


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s.kind], s.start.cast("string"), s.end.cast("string"))), ",")


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """The weak candidates (key, mark, start, kind, end) that have their complementary parts in scope."""
    role = F.when(F.col("kind").isin(1, 3), F.lit("identifier")).when(F.col("kind").isin(0, 2, 4), F.lit("secret"))
    placed = parts.withColumn("bucket", F.floor(F.col("start") / scope))
    ends = placed.select("key", "mark", "bucket", role.alias("role"), "start").where("role is not null").groupBy("key", "mark", "bucket", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    weak = placed.where("kind >= 3").withColumn("near", F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)))
    e = ends.select(F.col("key").alias("e_key"), F.col("mark").alias("e_mark"), F.col("bucket").alias("e_bucket"), "role", "first", "last")
    same = F.col("key").eqNullSafe(F.col("e_key")) & (F.col("mark") == F.col("e_mark")) & (F.col("near") == F.col("e_bucket"))
    # all starts of one bucket are in scope of each other; of a bucket beside, the nearest start decides
    reach = F.when(F.col("near") == F.col("bucket"), F.lit(True)).when(F.col("near") < F.col("bucket"), F.col("start") - F.col("last") <= scope).otherwise(F.col("first") - F.col("start") <= scope)
    pairs = weak.join(e, same).where(reach)
    near = pairs.groupBy("key", "mark", "start", "kind", "end").agg(F.bool_or(F.col("role") == "identifier").alias("identifier"), F.bool_or(F.col("role") == "secret").alias("secret"))
    complete = F.when(F.col("kind") == 3, F.col("secret")).when(F.col("kind") == 4, F.col("identifier")).otherwise(F.col("identifier") & F.col("secret"))
    return near.where(complete).select("key", "mark", "start", "kind", "end")


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """key, base (array of spans), linked (array of weak spans that were linked); one row per document."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(
        spans(F.col("text"), ASSIGN, "assign", lambda v: F.char_length(v) >= 6, group=1),
        spans(F.col("text"), ACCESS, "access", lambda v: F.char_length(v) >= 20),
        # runs of 24 and more only: the same spans as all runs with the short ones dropped
        spans(F.col("text"), r"(?<![0-9a-f])[0-9a-f]{24,}", "hex", lambda v: F.char_length(v) >= 24),
    )
    weak = F.concat(*(spans(F.col("text"), p, k, lambda v: F.lit(True)) for p, k in ((IDENT, "ident"), (KEY, "key"), (ENDPOINT, "endpoint"))))
    found = docs.select(F.col(key).alias("key"), body.alias("text")).select("key", F.xxhash64("text").alias("mark"), base.alias("base"), weak.alias("weak"))
    found = store.written(found, "secrets")
    parts = found.where(F.size("weak") > 0).select("key", "mark", F.explode(F.concat("base", "weak")).alias("s")).select("key", "mark", "s.start", "s.kind", "s.end").distinct()
    linked = _linked(parts, scope).groupBy("key", "mark").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))
    linked = linked.select(F.col("key").alias("l_key"), F.col("mark").alias("l_mark"), "linked")
    out = found.join(linked, F.col("key").eqNullSafe(F.col("l_key")) & (F.col("mark") == F.col("l_mark")), "left")
    return out.select(F.col("key").alias(key), "base", F.coalesce("linked", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")).alias("linked"))


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """key, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    found = scan(docs, key=key, text=text, scope=scope)
    return found.select(key, count("assign"), count("access"), count("hex"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", "linked")).alias("spans"), F.size("linked").cast("long").alias("n_linked"))
