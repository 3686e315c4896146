"""Secrets in documents, with parts of one credential linked to each other.

Strong spans are reported wherever they stand: assignments to names of secrets, access ids of a
known form, and long runs of hexadecimal digits.  Of each kind the leftmost matches that do not
overlap count, as many as fit.

Weak candidates say nothing by themselves: an assigned user or client id, a run of exactly 40
base64 characters, an address.  They are the parts of a credential that comes in several, so each
is reported only if the parts that complete it stand near: an identifier needs a secret, a
secret an identifier, an endpoint both.  Near means in the same scope, a stretch of lines without a
blank one, with a start or an end of the other part within `reach` code points of the candidate.  A weak
candidate that overlaps a strong span is dropped.

Texts are searched in place, without a shuffle.  Only parts of documents with weak candidates become
rows.  Their ends are binned by position; a bin keeps its first and last end per role, and a
candidate meets the few bins around it by an equi-join.  So a scope with very many parts is neither
one task nor a set of pairs, and no link is lost.

Positions are code points, ends exclusive.  A null text is an empty one, which has no spans.
Repeated rows, of equal ids too, are scanned one by one.  A text is searched whole, in the memory
that its own length asks for.  Ties do not arise, as spans of a kind never overlap; spans
of one start are in the order of KINDS.  Empty table: no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramloom.llm.common import stage

# The patterns of strong spans, and how long a match must be.
ASSIGN = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGNED = 6
ACCESS = "AKIA[A-Z0-9]+"
ACCESS_LENGTH = 20
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"

# The patterns of weak candidates.
IDENTIFIER = (
    r"(?ai)(account|access_?key|app|application|client|key|login|tenant|user)_?(id|name)?"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{4,})"""
)
KEY = "(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}"
KEY_LENGTH = 40
ENDPOINT = (
    r"(?ai)(amqp|ftp|https?|mongodb|mysql|postgres|postgresql|redis|s3)://[A-Za-z0-9_.:@/?&=%+~#-]{4,}"
    r"""|(database|endpoint|host|hostname|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.:/-]{4,}"""
)
SCOPE_END = r"\n[\x20\t\r]*\n"

KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")
_STRONG = 3
#: What a kind is a part of a credential as; endpoints complete nothing.
_ROLE = (1, 0, 1, 0, 1, 2)
REACH = 400

_PART = "struct<start bigint, kind int, end bigint, scope bigint, value string>"
_SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
    f"strong array<{_PART}>, weak array<{_PART}>"
)

_assign, _access, _hex, _identifier, _key, _endpoint, _scope_end = map(
    re.compile, (ASSIGN, ACCESS, HEX, IDENTIFIER, KEY, ENDPOINT, SCOPE_END)
)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")


def _strong(text: str, lower: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strong spans; `lower` only tells texts without any name of a secret."""
    found = []
    if any(word in lower for word in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in _assign.finditer(text) if m.end(2) - m.start(2) >= ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _access.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in _hex.finditer(text)]
    return sorted(found)


def _looks_like_key(run: str) -> bool:
    return len(run) == KEY_LENGTH and all(re.search(c, run) for c in ("[a-z]", "[A-Z]", "[0-9]"))


def _weak(text: str, lower: str, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of weak candidates apart from all strong spans."""
    assigns = "=" in lower or ":" in lower
    found = [(m.start(), 4, m.end()) for m in _key.finditer(text) if _looks_like_key(m.group())]
    if assigns:
        found += [(m.start(), kind, m.end()) for kind, p in ((3, _identifier), (5, _endpoint)) for m in p.finditer(text)]
    if strong:
        # Spans of several kinds may nest, so the furthest end so far decides.
        begins, furthest = [s for s, _, _ in strong], []
        for _, _, end in strong:
            furthest.append(max(end, furthest[-1] if furthest else 0))
        found = [
            (start, kind, end)
            for start, kind, end in found
            if not (at := bisect_left(begins, end)) or furthest[at - 1] <= start
        ]
    return sorted(found)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            lower = text.lower()
            strong = _strong(text, lower)
            weak = _weak(text, lower, strong)
            scopes = [m.start() for m in _scope_end.finditer(text)] if weak else []

            def parts(spans: list, text: str = text, scopes: list = scopes) -> list[dict]:
                return [
                    {"start": s, "kind": k, "end": e, "scope": bisect_left(scopes, s), "value": text[s:e]}
                    for s, k, e in spans
                ]

            base = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in strong)
            counts = [sum(k == kind for _, k, _ in strong) for kind in range(_STRONG)]
            rows.append((doc_id, *counts, hashlib.sha256(base.encode()).hexdigest(), parts(strong), parts(weak)))
        part = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("scope", pa.int64()), ("value", pa.string())])
        names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "strong", "weak"]
        types = [pa.int64()] * 4 + [pa.string()] + [pa.list_(part)] * 2
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def _linked(searched: DataFrame, reach: int) -> DataFrame:
    """(row, linked): the weak candidates of a row whose complements stand near."""
    role = F.element_at(F.array(*[F.lit(r) for r in _ROLE]), F.col("part.kind") + 1)
    asking = searched.filter(F.size("weak") > 0)
    parts = asking.select("row", F.explode(F.concat("strong", "weak")).alias("part"))
    ends = parts.select(
        "row", "part.scope", role.alias("role"), F.explode(F.array("part.start", "part.end")).alias("at")
    ).filter("role < 2")
    bins = ends.groupBy("row", "scope", "role", F.floor(F.col("at") / reach).alias("bin")).agg(
        F.min("at").alias("first"), F.max("at").alias("last")
    )
    weak = asking.select("row", F.explode("weak").alias("part")).select(
        "row", "part", "part.scope", role.alias("own"), (F.col("part.start") - reach).alias("low"), (F.col("part.end") + reach).alias("high")
    )
    around = weak.withColumn("bin", F.explode(F.sequence(F.floor(F.col("low") / reach), F.floor(F.col("high") / reach))))
    met = around.join(bins, ["row", "scope", "bin"]).filter("role <> own and last >= low and first <= high")
    complete = met.groupBy("row", "part").agg(
        F.max(F.col("role") == 0).alias("identifier"), F.max(F.col("role") == 1).alias("secret"), F.min("own").alias("own")
    )
    enough = (F.col("own") < 2) | (F.col("identifier") & F.col("secret"))
    return complete.filter(enough).groupBy("row").agg(F.collect_list("part").alias("linked"))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: counts and digest of the strong spans, all spans as text, and `found`.

    `found` has each span's start, kind (its number in KINDS), end, scope and text.
    """
    if reach < 1:
        raise ValueError("reach must be at least 1")
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    searched = texts.mapInArrow(_search, _SCHEMA).withColumn("row", F.monotonically_increasing_id())
    searched = stage(searched, "searched")
    found = F.array_sort(F.concat("strong", F.coalesce("linked", F.array().cast(f"array<{_PART}>"))))
    named = F.array(*[F.lit(k) for k in KINDS])

    def span(part: F.Column) -> F.Column:
        return F.concat_ws(":", F.get(named, part["kind"]), part["start"].cast("string"), part["end"].cast("string"))

    return (
        searched.join(_linked(searched, reach), "row", "left")
        .withColumn("found", found)
        .withColumn("spans", F.array_join(F.transform("found", span), ","))
        .select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found")
    )
