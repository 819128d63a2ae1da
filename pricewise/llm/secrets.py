"""Secret scan with corpus-wide ownership of every candidate.

``scan`` finds the base kinds in each whole text (map only): assignments, access keys
and hex runs; and further candidates: whole private-key blocks and, outside all these
spans, long mixed tokens. A block reaches from its BEGIN line to its END line, or to
the end of the base64 text where END is missing; its value is the body without white
space, so ownership is by key. A header without any body is no key. ``ownership`` then
aggregates candidate hashes over the corpus: in how many repositories and of how many owners does a value occur? A value that
``WIDE_OWNERS`` owners or more hold is a copied example; a value of fewer owners that
looks live (random-looking, no placeholder) is a credential. Base spans always stay,
with their class; the further candidates are reported only if they are credentials.

Scale: a text is read once; only candidate rows (hash, owner, repository) are
shuffled, made distinct before the shuffle, so a value copied into a third of all
documents is one row per task. The join back is by hash, split by adaptive execution.

Edge cases: null text is empty (no spans); null owners and repositories count as one
value each; repeated rows are reported each; ties cannot occur (spans of one kind do
not overlap, and order is by start, then kind); empty tables give empty results; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are taken whole, so short ones need not match first
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----")
PEM_END = re.compile(r"-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----")
#: A body without END: whole lines of base64 (and the headers of an encrypted key), or long runs.
_BREAK = r"[ \t]*+(?:\r?\n|(?:\\r)?\\n)[ \t]*+"
PEM_BODY = re.compile(rf"(?:{_BREAK}(?:(?:Proc-Type|DEK-Info):[^\r\n\\]*(?:{_BREAK}(?={_BREAK}))?|[A-Za-z0-9+/]++={{0,2}}(?={_BREAK}|[ \t]*+\Z))"
                      r"|(?:\s|\\[nrt])*+[A-Za-z0-9+/]{16,}={0,2})*")
_PEM_SPACE = re.compile(r"\s|\\[nrt]")
MIN_ASSIGN, MIN_ACCESS = 12, 18
#: Order of kinds at one start.
KINDS = ("assign", "access", "hex", "token", "pem")
BASE = KINDS[:3]
WIDE_OWNERS = 3
MIN_ENTROPY = 3.0
PLACEHOLDERS = ("example", "sample", "dummy", "changeme", "placeholder", "your", "test", "xxxx", "1234567", "abcdef", "0000")


def _bits(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_live(value: str) -> bool:
    """Random-looking and free of placeholder words."""
    low = value.lower()
    return not any(p in low for p in PLACEHOLDERS) and any(c.isdigit() for c in value) and _bits(value) >= MIN_ENTROPY


def _mixed(value: str) -> bool:
    return any(c.islower() for c in value) and any(c.isupper() for c in value) and any(c.isdigit() for c in value) and _bits(value) >= 3.5


#: What a text must hold for a kind to occur in it, as linear-time patterns over whole
#: columns: a first test only, each at least as wide as the kind's own pattern.
HINTS = {
    "assign": """(?i)(password|passwd|secret|token|api_?key)["']? *[:=]""",
    "access": "AKIA[A-Z0-9]{14}",
    "hex": "[0-9a-f]{16}",
    "token": "[A-Za-z0-9+/_-]{20}",
    "pem": "PRIVATE KEY-----",
}


def _pem_blocks(text: str) -> list[tuple[str, int, int, str]]:
    """("pem", start, end, body without white space) of every private key with a body."""
    out = []
    for m in PEM.finditer(text):
        dashes = text.find("-----", m.end())
        last = PEM_END.match(text, dashes) if dashes >= 0 else None
        stop = dashes if last else PEM_BODY.match(text, m.end()).end()
        body = _PEM_SPACE.sub("", text[m.end():stop])
        if any(c.isalnum() for c in body):
            out.append(("pem", m.start(), last.end() if last else stop, body))
    return out


def spans_of(text: str, kinds: set[str] = frozenset(KINDS)) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, secret value) by start, then kind; ends are exclusive code points."""
    base, more = [], []
    if "assign" in kinds:
        base += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "access" in kinds:
        base += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    if "hex" in kinds:
        base += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    if "token" in kinds:
        more += [("token", m.start(), m.end(), m[0]) for m in TOKEN.finditer(text) if _mixed(m[0])]
    keys = _pem_blocks(text) if "pem" in kinds else []
    taken = [(s, e) for _, s, e, _ in base + keys]
    base += keys
    base += [x for x in more if not any(x[1] < e and s < x[2] for s, e in taken)]
    return sorted(base, key=lambda x: (x[1], KINDS.index(x[0])))





def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """(doc_id, owner, repo, candidates): every candidate of each row, values as SHA-256."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("owner", T.StringType()),
                           T.StructField("repo", T.StringType()), T.StructField("candidates", T.ArrayType(T.StructType([
                               T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                               T.StructField("hash", T.StringType()), T.StructField("live", T.BooleanType())])))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.string()), ("live", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(3).fill_null("")
            hints = {k: pc.match_substring_regex(text, p).to_numpy(zero_copy_only=False) for k, p in HINTS.items()}
            found = [[] for _ in range(b.num_rows)]
            for i in np.flatnonzero(np.logical_or.reduce(list(hints.values()))):
                found[i] = [{"kind": k, "start": s, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest(), "live": looks_live(v) or k == "pem"}
                            for k, s, e, v in spans_of(text[int(i)].as_py(), {k for k in KINDS if hints[k][i]})]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(found, kind)], names=["doc_id", "owner", "repo", "candidates"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
                       F.col(repo_col).cast("string").alias("repo"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, repositories, owners): distinct counts over (hash, owner, repo) rows.
    A repository belongs to its owner; equal names of two owners are two."""
    pairs = candidates.select("hash", "owner", "repo").distinct()
    return (pairs.groupBy("hash", "owner").agg(F.count("*").alias("n"))
            .groupBy("hash").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners")))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_col: str = "doc_id", wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """(doc_id, spans) for every row; spans: kind, start, end, base, label, repositories,
    owners, in order. Label: ``copied`` (wide_owners or more), ``live`` or ``plain``."""
    scanned = cut_lineage(scan(docs, id_col, text_col, owner_col, repo_col).withColumn("row", F.monotonically_increasing_id()), "candidates")
    each = scanned.select("row", "owner", "repo", F.explode("candidates").alias("c")).select("row", "owner", "repo", "c.*")
    owned = ownership(each)
    label = F.when(F.col("owners") >= wide_owners, "copied").when(F.col("live"), "live").otherwise("plain")
    base = F.col("kind").isin(*BASE)
    order = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    span = F.struct("start", order.alias("order"), "kind", "end", base.alias("base"), label.alias("label"), "repositories", "owners")
    known = (each.join(owned, "hash").select("row", span.alias("s")).where("s.base or s.label = 'live'")
             .groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("spans")))
    empty = F.array().cast(known.schema["spans"].dataType)
    return scanned.select("row", "doc_id").join(known, "row", "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))


def span_text(spans) -> "F.Column":
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
