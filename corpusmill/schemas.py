"""Fixed schemas of the tables; the order of columns is part of the contract."""

from __future__ import annotations

from pyspark.sql import types as T


def _of(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


_S, _L, _I = T.StringType(), T.LongType(), T.IntegerType()

DOCUMENTS = _of(
    wiki=_S, page_id=_L, revision_id=_L, revision_timestamp=_S, title=_S, url=_S, text=_S, text_sha256=_S, split=_S, license=_S
)
ATTRIBUTION_COLUMNS = ("wiki", "page_id", "revision_id", "revision_timestamp", "title", "url", "license")
ATTRIBUTION = T.StructType([DOCUMENTS[c] for c in ATTRIBUTION_COLUMNS])
PAGE_DECISIONS = _of(page_id=_L, stream_ordinal=_I, decision=_S, reason=_S)
DROPPED_PAGES = _of(page_id=_L, title=_S, reason=_S)
SEGMENT_INDEX = _of(byte_offset=_L, page_id=_L, title=_S)
SEGMENT_RANGES = T.StructType(
    [T.StructField("ordinal", _I), T.StructField("start", _L), T.StructField("end", _L), T.StructField("first_page_id", _L),
     T.StructField("pages", _L), T.StructField("page_ids", T.ArrayType(_L)), T.StructField("page_ids_sha256", _S)]
)
REVIEW_DECISIONS = _of(page_id=_L, revision_id=_L, reviewer=_S, reviewed_at=_S, label=_S, notes=_S)
REVIEW_CANDIDATES = _of(
    stratum=_S, page_id=_L, revision_id=_L, revision_timestamp=_S, title=_S, url=_S, oldid_url=_S, text_sha256=_S,
    extracted_text=_S, human_label=_S, human_notes=_S,
)
PAGES = T.StructType(
    [T.StructField("ordinal", _I), T.StructField("position", _I), T.StructField("expected_page_id", _L), T.StructField("title", _S),
     T.StructField("ns", _S), T.StructField("id", _S), T.StructField("redirect", _of(title=_S)),
     T.StructField("revision", _of(id=_S, rev_timestamp=_S, text=_S)), T.StructField("problem", _S),
     T.StructField("segment_bytes", _L), T.StructField("segment_sha256", _S)]
)
VIOLATIONS = _of(check=_S, entity=_S, message=_S)
