"""Secret scans that link the parts of a credential.

Strong patterns are reported on their own. Weak ones, a name that could be an
account, a string that could be a key, an address that could be an endpoint, say
nothing alone: they are reported only where the parts that complete them lie in
the same scope and within reach.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.llm.common import settled

# Fixed patterns of the strong kinds, in the order in which spans that start together are listed.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
STRONG = ("assign", "access", "hex")
# Weak kinds: the part of a credential that each can be.
WEAK = {
    "account": r"""(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    "key": r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/=_-])",
    "endpoint": r"""(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]{3,}""",
}
KINDS = (*STRONG, *WEAK)
#: The part each kind supplies.
PART = {"assign": "secret", "access": "identity", "hex": "secret", "account": "identity", "key": "secret", "endpoint": "endpoint"}
#: The parts of which all must be near for a weak find to count.
NEEDS = {"account": ("secret",), "key": ("identity",), "endpoint": ("identity", "secret")}

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS, _HEX = re.compile(ACCESS), re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_WEAK = {k: re.compile(v, re.IGNORECASE | re.ASCII) for k, v in WEAK.items()}
_SCOPE = re.compile(r"\n[\x20\t\r]*\n")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCOUNTS = ("user", "login", "account", "client", "access")
_MIXED = (re.compile("[A-Z]"), re.compile("[a-z]"), re.compile("[0-9]"))


def strong_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the strong finds; a match that fails a length rule is dropped without a retry."""
    out = []
    lower = text.lower()
    if any(w in lower for w in _WORDS):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # runs of 24 and more are the matches of HEX that are long enough
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def weak_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    lower = text.lower()
    if any(w in lower for w in _ACCOUNTS):
        out += [("account", *m.span()) for m in _WEAK["account"].finditer(text)]
    if "://" in text:
        out += [("endpoint", *m.span()) for m in _WEAK["endpoint"].finditer(text)]
    return out + [("key", *m.span()) for m in _WEAK["key"].finditer(text) if all(c.search(m.group()) for c in _MIXED)]


def found_parts(text: str) -> list[tuple[int, int, int, int]]:
    """(index of the kind, start, end, scope) of all finds of a text; scopes are parted by empty lines."""
    spans = strong_spans(text) + weak_spans(text)
    if not spans:
        return []
    spans.sort(key=lambda s: s[1])
    breaks = [m.start() for m in _SCOPE.finditer(text)]
    out, scope = [], 0
    for kind, start, end in spans:
        while scope < len(breaks) and breaks[scope] < start:
            scope += 1
        out.append((KINDS.index(kind), start, end, scope))
    return out


def _scanned(docs: DataFrame, key: str, text: str) -> DataFrame:
    import pyarrow as pa
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("scope", pa.int32())]))
    names = ["kind", "start", "end", "scope"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [[dict(zip(names, p, strict=True)) for p in found_parts(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, kind)], names=["_key", "_parts"])

    schema = "_key long, _parts array<struct<kind:int,start:int,end:int,scope:int>>"
    return docs.select(F.col(key).cast("long").alias("_key"), F.col(text)).mapInArrow(run, schema)


def linked_parts(parts: DataFrame, reach: int) -> DataFrame:
    """Weak finds (_row, kind, start, end, scope) whose complements start within ``reach`` characters in their scope.

    An interval join: starts are cut into bins of ``reach`` characters. Of the complements in a bin only the first and
    last start matter, so a bin joins as one row; in the own bin any will do, in the bins beside it the nearest decides.
    """
    pick = lambda table: F.element_at(F.array(*(F.lit(table(k)) for k in KINDS)), F.col("kind") + 1)
    bins = parts.select("_row", "scope", pick(lambda k: PART[k]).alias("part"), F.floor(F.col("start") / reach).alias("bin"), "start")
    bins = bins.groupBy("_row", "scope", "part", "bin").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    needs = F.element_at(F.array(*(F.array(*map(F.lit, NEEDS.get(k, ("",)))) for k in KINDS)), F.col("kind") + 1)
    weak = parts.where(F.col("kind") >= len(STRONG)).withColumn("part", F.explode(needs))
    asked = weak.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / reach) - 1, F.floor(F.col("start") / reach) + 1)))
    near = asked.join(bins, ["_row", "scope", "part", "bin"]).where(
        F.least(F.abs(F.col("start") - F.col("first")), F.abs(F.col("start") - F.col("last"))) <= F.when(
            F.col("bin") == F.floor(F.col("start") / reach), reach - 1).otherwise(reach))
    met = near.groupBy("_row", "kind", "start", "end", "scope").agg(F.countDistinct("part").alias("met"))
    count = pick(lambda k: len(NEEDS.get(k, ())))
    return met.where(F.col("met") == count).select("_row", "kind", "start", "end", "scope")


def secret_spans(docs: DataFrame, *, key: str = "doc_id", text: str = "text", reach: int = 400) -> DataFrame:
    """One row per document: ``key`` and _spans, an array of (start, kind, end) in order; kind is an index into ``KINDS``.

    Offsets are code points of the whole text, ends exclusive. Weak kinds count only where the parts named in ``NEEDS``
    start within ``reach`` characters in the same scope; one find may serve several. A null text has no finds; repeated
    rows are documents of their own; other columns are left out; an empty table gives no rows.
    """
    rows = settled(_scanned(docs, key, text).withColumn("_row", F.monotonically_increasing_id()))
    parts = rows.where(F.size("_parts") > 0).select("_row", F.explode("_parts").alias("_p")).select("_row", "_p.*")
    linked = linked_parts(parts, reach).groupBy("_row").agg(F.collect_list(F.struct("kind", "start", "end", "scope")).alias("_weak"))
    strong = F.filter("_parts", lambda p: p["kind"] < len(STRONG))
    every = F.concat(strong, F.coalesce("_weak", F.expr("cast(array() as array<struct<kind:int,start:int,end:int,scope:int>>)")))
    spans = F.array_sort(F.transform(every, lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end"))))
    return rows.join(linked, "_row", "left").select(F.col("_key").alias(key), spans.alias("_spans"))


def of_kind(spans: str, kind: int) -> Column:
    """How many of the spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_list(spans: Column, kinds: Sequence[str] = KINDS) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
