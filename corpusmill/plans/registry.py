"""The core queries and their SQL."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import functions as F

from corpusmill.functions import columns as C
from corpusmill.functions.markup import BOILERPLATE_HEADINGS, RESIDUE
from corpusmill.functions.sections import without_boilerplate
from corpusmill.operators import cascade, catalog, digests, documents, duplicates, ledger, packing, review
from corpusmill.plans import cases, tokens
from corpusmill.runtime import checkpointed, shared_folder, table
from corpusmill.schemas import ATTRIBUTION_COLUMNS, DOCUMENTS
from corpusmill.sources.shards import read_shards
from corpusmill.streaming import arrivals

#: Host of the test data's articles; a corpus of the real wiki names its own.
SITE = "millwiki.example"
#: Split shares in the packing queries, sequence length and sequences of a shard.
LENGTH, PER_SHARD = 128, 4
END = "[EOS]"


def split_assignment(spark, d):
    return documents.split_assignment(table(spark, d, "wiki_documents"))


def split_summary(spark, d):
    return documents.split_summary(table(spark, d, "wiki_documents"))


def text_fingerprint(spark, d):
    return documents.text_fingerprints(table(spark, d, "wiki_documents"))


def article_urls(spark, d):
    return documents.article_urls(table(spark, d, "wiki_documents"), SITE)


def attribution(spark, d):
    return documents.attribution(table(spark, d, "wiki_documents"))


def attribution_mismatches(spark, d):
    """Documents against their attribution: none should differ."""
    rows = table(spark, d, "wiki_documents")
    return documents.attribution_mismatches(rows, documents.attribution(rows))


def split_intersection(spark, d):
    return documents.split_intersection(table(spark, d, "wiki_documents").select("page_id", "split"))


def repeated_pages(spark, d):
    return documents.order_violations(table(spark, d, "wiki_documents"))


def exact_duplicate_groups(spark, d):
    groups = duplicates.exact_duplicate_groups(table(spark, d, "wiki_documents"))
    return groups.withColumn("splits", F.array_join("splits", ","))


def cross_split_groups(spark, d):
    return duplicates.cross_split_groups(table(spark, d, "wiki_documents"))


def exact_audit(spark, d):
    return duplicates.exact_audit(table(spark, d, "wiki_documents"))


def near_sample(spark, d):
    return duplicates.near_sample(table(spark, d, "wiki_documents")).select("page_id", "score")


def simhash(spark, d):
    sample = duplicates.near_sample(table(spark, d, "wiki_documents"))
    return duplicates.simhashes(sample).select("page_id", "high", "low")


def near_pairs(spark, d):
    sample = duplicates.near_sample(table(spark, d, "wiki_documents"))
    return duplicates.near_pairs(duplicates.simhashes(sample)).select("page_id_a", "page_id_b", "distance")


def near_examples(spark, d):
    sample = duplicates.near_sample(table(spark, d, "wiki_documents"))
    return duplicates.near_examples(duplicates.simhashes(sample))


def near_audit(spark, d):
    return duplicates.near_audit(table(spark, d, "wiki_documents"))


def review_strata(spark, d):
    return review.review_strata(table(spark, d, "wiki_documents"))


def review_candidates(spark, d):
    return review.review_candidates(table(spark, d, "wiki_documents")).drop("human_label", "human_notes")


def review_problems(spark, d):
    """Of the decisions against all pages of the documents as candidates."""
    candidates = table(spark, d, "wiki_documents").where("text is not null").select("page_id", "revision_id")
    return review.decision_problems(table(spark, d, "review_decisions"), candidates)


def review_labels(spark, d):
    return review.label_counts(table(spark, d, "review_decisions"), table(spark, d, "wiki_documents"))


def review_reviewers(spark, d):
    return review.reviewers(table(spark, d, "review_decisions"))


def structural_drops(spark, d):
    return cascade.structural_decisions(table(spark, d, "dump_pages"))


def drop_cascade(spark, d):
    pages = cascade.extracted(table(spark, d, "dump_pages"))
    return pages.select("page_id", "revision_id", "title", "reason", F.length("text").cast("bigint").alias("chars"), C.text_hash(F.col("text")).alias("text_sha256"))


def extracted_documents(spark, d):
    return cascade.documents_of(cascade.extracted(table(spark, d, "dump_pages")), "simplewiki", SITE, "CC-BY-SA-4.0")


def extraction_reasons(spark, d):
    pages = cascade.extracted(table(spark, d, "dump_pages")).withColumn("ordinal", F.lit(0))
    return ledger.drop_counts(cascade.decisions_of(pages))


def drop_counts(spark, d):
    return ledger.drop_counts(table(spark, d, "page_decisions"))


def accounting(spark, d):
    return ledger.accounting(table(spark, d, "page_decisions"))


def decision_problems(spark, d):
    return ledger.decision_problems(table(spark, d, "page_decisions"))


def decisions_against_index(spark, d):
    return ledger.decisions_against_index(table(spark, d, "page_decisions"), table(spark, d, "segment_index"))


def decisions_against_documents(spark, d):
    return ledger.decisions_against_documents(table(spark, d, "page_decisions"), table(spark, d, "wiki_documents"))


def page_decisions(spark, d):
    """All decisions as the union of emitted and dropped ones, each once, in the order of segments and pages."""
    rows = table(spark, d, "page_decisions").distinct()
    emitted, dropped = rows.where("decision = 'emitted'"), rows.where("decision = 'dropped'")
    return emitted.unionByName(dropped).orderBy("stream_ordinal", F.col("page_id").asc_nulls_first())


def segment_ranges(spark, d):
    return catalog.segment_ranges(table(spark, d, "segment_index")).drop("page_ids")


def segment_pages(spark, d):
    ranges = catalog.segment_ranges(table(spark, d, "segment_index"))
    return ranges.select("ordinal", F.posexplode("page_ids").alias("position", "page_id"))


def page_positions(spark, d):
    """The decided pages of each segment in their order against those the index lists."""
    decided = table(spark, d, "page_decisions").where("page_id is not null and stream_ordinal is not null").select(F.col("stream_ordinal").alias("ordinal"), "page_id").distinct()
    listed = decided.groupBy("ordinal").agg(F.array_sort(F.collect_list("page_id")).alias("pages"))
    return ledger.positions_against_index(listed.select("ordinal", F.posexplode("pages").alias("position", "page_id")), segment_pages(spark, d))


def ledger_against_ranges(spark, d):
    """The accounting of the decisions against the segments of the index."""
    return ledger.ledger_against_ranges(accounting(spark, d), catalog.segment_ranges(table(spark, d, "segment_index")))


def decision_multiset(spark, d):
    """Pages that decisions and index lines hold in different numbers."""
    return ledger.multiset_difference(table(spark, d, "page_decisions"), table(spark, d, "segment_index"))


def documents_in_order(spark, d):
    """The place of each page in the order of identifiers, and the page before it."""
    pages = table(spark, d, "wiki_documents").where("page_id is not null").select("page_id").distinct()
    return packing.with_neighbours(pages, "page_id", "page_id").select("page_id", "place", "before")


def dropped_lines(spark, d):
    """The ledger of dropped pages as lines of compact JSON with sorted keys."""
    dropped = cascade.structural_decisions(table(spark, d, "dump_pages")).where("reason is not null")
    return dropped.select(F.to_json(F.struct("page_id", "reason", "title"), {"ignoreNullFields": "false"}).alias("line"))


def dropped_scan(spark, d):
    """The ledger of dropped pages written as JSON lines and read again."""
    folder = f"{shared_folder(spark)}/dropped-{uuid.uuid4().hex}"
    dropped_lines(spark, d).write.text(folder)
    return spark.read.schema("page_id bigint, reason string, title string").option("mode", "FAILFAST").json(folder)


def index_lines(spark, d):
    """The index written as text lines and parsed again; a line without a title has two fields."""
    rows = table(spark, d, "segment_index")
    lines = rows.select(F.concat_ws(":", F.col("byte_offset").cast("string"), F.col("page_id").cast("string"), F.col("title")).alias("value"))
    return catalog.parse_index_lines(lines).drop("line")


def index_problems(spark, d):
    return catalog.index_problems(table(spark, d, "segment_index"))


def range_problems(spark, d):
    return catalog.range_problems(catalog.segment_ranges(table(spark, d, "segment_index")))


def remaining_segments(spark, d):
    """Segments of the index of which no page is decided."""
    ranges = catalog.segment_ranges(table(spark, d, "segment_index")).select("ordinal", "first_page_id", "pages")
    return catalog.remaining_segments(ranges, table(spark, d, "page_decisions").select(F.col("stream_ordinal").alias("ordinal")))


def residual_markup(spark, d):
    """Kinds of markup in raw page texts."""
    rows = table(spark, d, "dump_pages").select("id", F.col("revision.text").alias("text"))
    return rows.select("id", F.array_join(residue_column(), ",").alias("kinds")).where("kinds <> ''")


def residue_column():
    from corpusmill.functions.markup import residue_kinds

    return residue_kinds(F.col("text"))


def residue_report(spark, d):
    """How many raw texts hold markup, and the first 20 of their pages."""
    rows = table(spark, d, "dump_pages").select(C.parsed_integer(F.col("id")).alias("page_id"), F.col("revision.text").alias("text"))
    return digests.residue_report(rows, residue_column())


def section_skip(spark, d):
    """Raw page texts without boilerplate sections."""
    rows = table(spark, d, "dump_pages").select("id", F.col("revision.text").alias("text")).where("text is not null")
    return rows.select("id", C.text_hash(without_boilerplate(F.col("text"))).alias("kept_sha256"))


def collapsed_text(spark, d):
    rows = table(spark, d, "wiki_documents").where("text is not null")
    return rows.select("page_id", C.text_hash(C.collapsed_lines(F.col("text"))).alias("collapsed_sha256")).distinct()


def composed_text(spark, d):
    return digests.composed_text(table(spark, d, "wiki_documents"))


def row_digests(spark, d):
    return digests.row_digests(table(spark, d, "wiki_documents"))


def corpus_digest(spark, d):
    return digests.corpus_digest(table(spark, d, "wiki_documents"))


def attribution_digest(spark, d):
    return digests.corpus_digest(table(spark, d, "wiki_documents"), ATTRIBUTION_COLUMNS)


def token_documents(spark, d):
    """Each page's lower-cased words with an end token, by split; null texts and pages in no split are left out."""
    rows = table(spark, d, "wiki_documents").select("page_id", C.tidy(F.col("split")).alias("split"), "text")
    rows = rows.where("page_id is not null and text is not null").where(F.col("split").isin("train", "validation", "test"))
    words = F.regexp_extract_all(F.replace(F.lower("text"), F.lit("ς"), F.lit("σ")), F.lit(C.WORD_RUN), F.lit(1))
    return rows.dropDuplicates(["page_id"]).select("split", "page_id", F.concat(words, F.array(F.lit(END))).alias("tokens"))


def token_pack(spark, d):
    packed = packing.packed_sequences(token_documents(spark, d), LENGTH, PER_SHARD)
    return packed.select("split", "sequence", "shard", F.sha2(F.array_join("tokens", " "), 256).alias("tokens_sha256"))


def token_shards(spark, d):
    return packing.shard_sizes(token_documents(spark, d), LENGTH, PER_SHARD)


def _written_shards(spark, d):
    """Shards of word lengths, the end token being 0, written to the shared folder; their summary and the folder."""
    rows = token_documents(spark, d)
    sized = rows.withColumn("tokens", F.transform("tokens", lambda t: F.when(t == END, 0).otherwise(F.length(t)).cast("bigint")))
    folder = Path(shared_folder(spark).removeprefix("file://").removeprefix("file:")) / f"shards-{uuid.uuid4().hex}"
    folder.mkdir(parents=True)
    return checkpointed(tokens.write_sequences(packing.packed_sequences(sized, LENGTH, PER_SHARD), folder, "uint16-le")), folder


def shard_files(spark, d):
    """Shards of the packed sequences after they are written: sequences and largest token."""
    return _written_shards(spark, d)[0]


def shard_scan(spark, d):
    """The sequences of written shards, read again."""
    _, folder = _written_shards(spark, d)
    name = F.regexp_extract("path", r"([a-z]+)-([0-9]+)\.bin$", 1)
    shard = F.regexp_extract("path", r"([a-z]+)-([0-9]+)\.bin$", 2).cast("bigint")
    rows = read_shards(spark, f"file://{folder}", "uint16-le", LENGTH)
    return rows.select(name.alias("split"), shard.alias("shard"), "sequence", F.sha2(F.array_join("tokens", " "), 256).alias("tokens_sha256"))


def dropped_tails(spark, d):
    return packing.dropped_tails(token_documents(spark, d), LENGTH)


def bigram_loss(spark, d):
    packed = packing.packed_sequences(token_documents(spark, d), LENGTH, PER_SHARD)
    return packing.bigram_loss(packed.where("split = 'train' and sequence = 0").select(F.posexplode("tokens").alias("position", "token")))


def latest_revisions(spark, d):
    return arrivals.latest_revisions(table(spark, d, "page_arrivals"))


def snapshot_arrivals(spark, d):
    return arrivals.arrival_summary(table(spark, d, "page_arrivals"))


def queries():
    """All core queries by name."""
    found = (
        split_assignment, split_summary, text_fingerprint, article_urls, attribution, attribution_mismatches, split_intersection,
        repeated_pages, exact_duplicate_groups, cross_split_groups, exact_audit, near_sample, simhash, near_pairs, near_examples, near_audit,
        review_strata, review_candidates, review_problems, review_labels, review_reviewers, structural_drops, dropped_lines, drop_cascade,
        extracted_documents, extraction_reasons, drop_counts, accounting, decision_problems, decisions_against_index,
        decisions_against_documents, page_decisions, segment_ranges, segment_pages, page_positions,
        ledger_against_ranges, decision_multiset, documents_in_order, dropped_scan, attribution_digest, shard_files, shard_scan, index_lines, index_problems, range_problems,
        remaining_segments, residual_markup, residue_report, section_skip, collapsed_text, composed_text, row_digests, corpus_digest,
        token_pack, token_shards, dropped_tails, bigram_loss, latest_revisions, snapshot_arrivals,
    )
    return {f.__name__: f for f in found} | cases.queries()


_U64 = "('0x' || substr(sha256({}), 1, 16))::UBIGINT"
_SPLIT = f"""CASE WHEN {_U64.format("'corpus-v1:' || page_id")} % 10000 < 9800 THEN 'train'
    WHEN {_U64.format("'corpus-v1:' || page_id")} % 10000 < 9900 THEN 'validation' ELSE 'test' END"""
_TIDY = "nullif(lower(regexp_replace({}, '^\\s+|\\s+$', '', 'g')), '')"
_STRATUM = """CASE WHEN length(text) < 500 THEN 'short_lt_500_chars' WHEN length(text) <= 5000 THEN 'medium_500_to_5000_chars'
    WHEN length(text) > 5000 THEN 'long_gt_5000_chars' END"""
_INT = "try_cast(replace(nullif(regexp_extract({}, '^\\s*([+-]?[0-9]+(?:_[0-9]+)*)\\s*$', 1), ''), '_', '') AS BIGINT)"
_SIMHASH = rf"""
    scored AS (SELECT DISTINCT ON (page_id) page_id, {_TIDY.format('split')} AS split, text, sha256(text) AS sha,
                      substr(sha256('near-v1:' || page_id), 1, 16) AS score
               FROM wiki_documents WHERE page_id IS NOT NULL AND text IS NOT NULL),
    sample AS (SELECT * FROM scored ORDER BY score, page_id LIMIT 5000),
    worded AS (SELECT *, list_slice(regexp_extract_all(replace(replace(lower(substr(text, 1, 8000)), 'ß', 'ss'), 'ς', 'σ'), '[\p{{L}}\p{{N}}_]+'), 1, 1000) AS w FROM sample),
    triples AS (SELECT page_id, sha256(concat_ws(chr(31), w[i], w[i + 1], w[i + 2])) AS h
                FROM (SELECT page_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded WHERE len(w) >= 20)),
    halves AS (SELECT page_id, ('0x' || substr(h, 1, 8))::BIGINT AS high, ('0x' || substr(h, 9, 8))::BIGINT AS low FROM triples),
    votes AS (SELECT page_id, b, sum(2 * ((high >> b) & 1) - 1) AS vh, sum(2 * ((low >> b) & 1) - 1) AS vl
              FROM halves, range(32) t(b) GROUP BY page_id, b),
    prints AS (SELECT page_id, sum(CASE WHEN vh >= 0 THEN 1::BIGINT << b ELSE 0 END)::BIGINT AS high,
                      sum(CASE WHEN vl >= 0 THEN 1::BIGINT << b ELSE 0 END)::BIGINT AS low FROM votes GROUP BY page_id)"""
_NEAR = f"""{_SIMHASH},
    full_prints AS (SELECT p.*, s.split, s.sha, s.score FROM prints p JOIN sample s USING (page_id)),
    candidates AS (SELECT a.page_id AS pa, b.page_id AS pb, a.split AS sa, b.split AS sb, a.sha = b.sha AS same, a.score AS score_a, b.score AS score_b,
                          CASE WHEN a.low & 65535 = b.low & 65535 THEN 0 WHEN a.low >> 16 = b.low >> 16 THEN 1 WHEN a.high & 65535 = b.high & 65535 THEN 2 ELSE 3 END AS band,
                          (bit_count(xor(a.high, b.high)) + bit_count(xor(a.low, b.low)))::INT AS distance
                   FROM full_prints a JOIN full_prints b ON (a.score, a.page_id) < (b.score, b.page_id)
                    AND (a.high >> 16 = b.high >> 16 OR a.high & 65535 = b.high & 65535 OR a.low >> 16 = b.low >> 16 OR a.low & 65535 = b.low & 65535))"""
_GROUPS = f"""
    pages AS (SELECT DISTINCT page_id, {_TIDY.format('split')} AS split, sha256(text) AS sha FROM wiki_documents
              WHERE page_id IS NOT NULL AND text IS NOT NULL),
    grouped AS (SELECT sha AS text_sha256, min(page_id) AS first_page_id, count(DISTINCT page_id) AS documents,
                       coalesce(list_sort(list_distinct(list(split) FILTER (split IS NOT NULL))), []) AS splits
                FROM pages GROUP BY sha HAVING count(DISTINCT page_id) > 1)"""
_SEGMENTS = """
    lines AS (SELECT DISTINCT byte_offset, page_id FROM segment_index WHERE byte_offset IS NOT NULL AND page_id IS NOT NULL),
    segments AS (SELECT byte_offset AS start, min(page_id) AS first_page_id, count(*) AS pages,
                        sha256(unhex(string_agg(printf('%016X', page_id), '' ORDER BY page_id))) AS page_ids_sha256
                 FROM lines GROUP BY byte_offset),
    ranges AS (SELECT (row_number() OVER (ORDER BY start) - 1)::INT AS ordinal, start, lead(start) OVER (ORDER BY start) - 1 AS "end",
                      first_page_id, pages, page_ids_sha256 FROM segments)"""
_TOKENS = rf"""
    docs AS (SELECT DISTINCT page_id, {_TIDY.format('split')} AS split,
                    list_append(regexp_extract_all(replace(lower(text), 'ς', 'σ'), '[\p{{L}}\p{{N}}_]+'), '{END}') AS tokens
             FROM wiki_documents WHERE page_id IS NOT NULL AND text IS NOT NULL
              AND {_TIDY.format('split')} IN ('train', 'validation', 'test')),
    placed AS (SELECT split, tokens, sum(len(tokens)) OVER (PARTITION BY split ORDER BY page_id) - len(tokens) AS start FROM docs),
    flat AS (SELECT split, start + i AS pos, tokens[i + 1] AS token FROM (SELECT split, start, tokens, unnest(range(len(tokens))) AS i FROM placed)),
    packed AS (SELECT split, (pos // {LENGTH})::BIGINT AS sequence, list(token ORDER BY pos) AS tokens FROM flat
               GROUP BY split, pos // {LENGTH} HAVING count(*) = {LENGTH}),
    totals AS (SELECT split, sum(len(tokens))::BIGINT AS tokens FROM docs GROUP BY split)"""


def _json_row(columns) -> str:
    return f"to_json({{{', '.join(f"'{c}': {c}" for c in sorted(columns))}}})::VARCHAR"


_ROW = _json_row(DOCUMENTS.fieldNames())


def _residue_sql() -> str:
    kinds = ", ".join(f"CASE WHEN regexp_matches(text, '{p.replace(chr(39), chr(39) * 2)}') THEN '{n}' END" for n, p in RESIDUE.items())
    return f"list_filter([{kinds}], lambda x: x IS NOT NULL)"


def oracle_sql():
    """SQL of the core queries that SQL can express."""
    attributed = "wiki, page_id, revision_id, revision_timestamp, title, url, license"
    raw = "(SELECT id, revision.text AS text FROM dump_pages)"
    reasons = "(VALUES ('empty_text'), ('insufficient_text'), ('invalid_page'), ('markup_residue'), ('non_article_namespace'), ('redirect')) r(reason)"
    page, space, revision = (_INT.format(c) for c in ("id", "ns", "revision.id"))
    blank = "coalesce(trim({}), '') = ''"
    return cases.oracle_sql() | {
        "split_assignment": f"SELECT DISTINCT page_id, {_SPLIT} AS split FROM wiki_documents WHERE page_id IS NOT NULL",
        "split_summary": f"SELECT split, count(*) AS pages FROM (SELECT DISTINCT page_id, {_SPLIT} AS split FROM wiki_documents WHERE page_id IS NOT NULL) GROUP BY split",
        "text_fingerprint": rf"""SELECT page_id, revision_id, sha256(text) AS computed_sha256, lower(text_sha256) = sha256(text) AS hash_holds,
            length(text) AS chars, len(regexp_extract_all(text, '[\p{{L}}\p{{Nl}}\p{{No}}]+')) AS words, {_STRATUM} AS stratum FROM wiki_documents""",
        "article_urls": f"""SELECT DISTINCT page_id, revision_id, url, url || '&oldid=' || revision_id AS oldid_url FROM (SELECT page_id, revision_id,
            CASE WHEN regexp_matches(wiki, '^.+wiki$') THEN 'https://' || left(wiki, -4) || '.{SITE}/?curid=' || page_id END AS url FROM wiki_documents)""",
        "attribution": f"SELECT DISTINCT {attributed} FROM wiki_documents",
        "attribution_mismatches": f"""WITH l AS (SELECT DISTINCT {attributed} FROM wiki_documents),
            r AS (SELECT DISTINCT {attributed} FROM wiki_documents)
            SELECT page_id, 'documents' AS side FROM (SELECT * FROM l EXCEPT SELECT * FROM r)
            UNION ALL SELECT page_id, 'attribution' AS side FROM (SELECT * FROM r EXCEPT SELECT * FROM l)""",
        "split_intersection": f"""SELECT page_id, count(DISTINCT split) AS splits FROM (SELECT page_id, {_TIDY.format('split')} AS split FROM wiki_documents) WHERE page_id IS NOT NULL GROUP BY page_id HAVING count(DISTINCT split) > 1""",
        "repeated_pages": "SELECT page_id, count(*) AS copies FROM wiki_documents WHERE page_id IS NOT NULL GROUP BY page_id HAVING count(*) > 1",
        "exact_duplicate_groups": f"WITH {_GROUPS} SELECT text_sha256, first_page_id, documents, array_to_string(splits, ',') AS splits FROM grouped",
        "cross_split_groups": f"""WITH {_GROUPS} SELECT first_page_id, documents, array_to_string(splits, ',') AS splits, text_sha256 FROM grouped
            WHERE len(splits) > 1 ORDER BY first_page_id, text_sha256 LIMIT 20""",
        "exact_audit": f"""WITH {_GROUPS} SELECT count(*) AS duplicate_groups, count(*) FILTER (len(splits) > 1) AS cross_split_groups,
            coalesce(sum(documents), 0)::BIGINT AS documents_in_groups FROM grouped""",
        "near_sample": f"WITH {_SIMHASH} SELECT page_id, score FROM sample",
        "simhash": f"WITH {_SIMHASH} SELECT page_id, high, low FROM prints",
        "near_pairs": f"WITH {_NEAR} SELECT least(pa, pb) AS page_id_a, greatest(pa, pb) AS page_id_b, distance FROM candidates WHERE NOT same AND distance <= 3",
        "near_examples": f"""WITH {_NEAR} SELECT pa AS page_id_a, pb AS page_id_b, sa AS split_a, sb AS split_b, distance FROM candidates
            WHERE NOT same AND distance <= 3 ORDER BY score_b, pb, band, score_a, pa LIMIT 20""",
        "near_audit": f"""WITH {_NEAR} SELECT 5000 AS requested_sample_size, (SELECT count(*) FROM sample) AS observed_sample_size,
            (SELECT count(*) FROM prints) AS eligible_documents, count(*) AS candidate_pairs_examined,
            count(*) FILTER (NOT same AND distance <= 3) AS near_duplicate_pairs_observed,
            count(*) FILTER (NOT same AND distance <= 3 AND sa IS DISTINCT FROM sb) AS cross_split_pairs_observed FROM candidates""",
        "review_strata": f"SELECT stratum, count(*) AS documents FROM (SELECT DISTINCT page_id, {_STRATUM} AS stratum FROM wiki_documents WHERE page_id IS NOT NULL AND text IS NOT NULL) GROUP BY stratum",
        "review_candidates": f"""WITH rows AS (SELECT DISTINCT ON (page_id, {_STRATUM}) *, {_STRATUM} AS stratum, substr(sha256('semantic-review-v1:' || page_id), 1, 16) AS score
            FROM wiki_documents WHERE page_id IS NOT NULL AND text IS NOT NULL ORDER BY page_id, {_STRATUM}, revision_id DESC NULLS LAST, text),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY score, page_id) AS place FROM rows)
            SELECT stratum, page_id, revision_id, revision_timestamp, title, url, url || '&oldid=' || revision_id AS oldid_url,
                   sha256(text) AS text_sha256, text AS extracted_text, place::INT AS place FROM ranked WHERE place <= 10""",
        "review_problems": f"""WITH known AS (SELECT DISTINCT page_id AS candidate, revision_id AS wanted FROM wiki_documents WHERE text IS NOT NULL),
            joined AS (SELECT d.*, k.* FROM review_decisions d LEFT JOIN known k ON d.page_id = k.candidate),
            found AS (SELECT page_id, 'not_a_candidate' AS problem FROM joined WHERE candidate IS NULL
              UNION ALL SELECT page_id, 'wrong_revision' FROM joined WHERE candidate IS NOT NULL AND revision_id IS DISTINCT FROM wanted
              UNION ALL SELECT page_id, 'invalid_label' FROM joined WHERE coalesce(label, '') NOT IN ('acceptable', 'minor_issue', 'major_issue', 'unreviewable')
              UNION ALL SELECT page_id, 'no_reviewer' FROM joined WHERE {blank.format('reviewer')}
              UNION ALL SELECT page_id, 'invalid_date' FROM joined WHERE reviewed_at IS NULL OR NOT regexp_matches(reviewed_at, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') OR try_cast(reviewed_at AS DATE) IS NULL
              UNION ALL SELECT page_id, 'invalid_notes' FROM joined WHERE notes IS NULL OR (coalesce(label <> 'acceptable', true) AND {blank.format('notes')})
              UNION ALL SELECT page_id, 'duplicated' FROM review_decisions GROUP BY page_id HAVING count(*) > 1
              UNION ALL SELECT candidate, 'missing' FROM known WHERE candidate NOT IN (SELECT page_id FROM review_decisions WHERE page_id IS NOT NULL))
            SELECT page_id, problem, count(*) AS "rows" FROM found GROUP BY page_id, problem""",
        "review_labels": f"""WITH strata AS (SELECT page_id, min({_STRATUM}) AS stratum FROM wiki_documents WHERE page_id IS NOT NULL AND text IS NOT NULL GROUP BY page_id),
            grid AS (SELECT * FROM (VALUES ('short_lt_500_chars'), ('medium_500_to_5000_chars'), ('long_gt_5000_chars')) s(stratum),
                                   (VALUES ('acceptable'), ('minor_issue'), ('major_issue'), ('unreviewable')) l(label)),
            counted AS (SELECT stratum, label, count(*) AS n FROM review_decisions JOIN strata USING (page_id) GROUP BY stratum, label)
            SELECT stratum, label, coalesce(n, 0) AS decisions FROM grid LEFT JOIN counted USING (stratum, label)""",
        "review_reviewers": """SELECT trim(reviewer) AS reviewer, count(*) AS decisions, count(DISTINCT page_id) AS pages, count(DISTINCT reviewed_at) AS dates,
            count(*) FILTER (label IN ('major_issue', 'unreviewable')) AS blocking FROM review_decisions WHERE trim(reviewer) <> '' GROUP BY trim(reviewer)""",
        "structural_drops": f"""SELECT {page} AS page_id, title, CASE
            WHEN {page} IS NULL OR {space} IS NULL OR coalesce(title, '') = '' THEN 'invalid_page' WHEN {space} <> 0 THEN 'non_article_namespace'
            WHEN redirect IS NOT NULL THEN 'redirect' WHEN revision IS NULL OR {revision} IS NULL THEN 'invalid_page'
            WHEN regexp_matches(lower(coalesce(revision.text, '')), '^\\s*#redirect') THEN 'redirect' END AS reason FROM dump_pages""",
        "dropped_lines": f"""SELECT to_json({{'page_id': page_id, 'reason': reason, 'title': title}})::VARCHAR AS line FROM (SELECT {page} AS page_id, title, CASE
            WHEN {page} IS NULL OR {space} IS NULL OR coalesce(title, '') = '' THEN 'invalid_page' WHEN {space} <> 0 THEN 'non_article_namespace'
            WHEN redirect IS NOT NULL THEN 'redirect' WHEN revision IS NULL OR {revision} IS NULL THEN 'invalid_page'
            WHEN regexp_matches(lower(coalesce(revision.text, '')), '^\\s*#redirect') THEN 'redirect' END AS reason FROM dump_pages) WHERE reason IS NOT NULL""",
        "page_positions": f"""WITH {_SEGMENTS}, listed AS (SELECT ordinal, (row_number() OVER (PARTITION BY byte_offset ORDER BY page_id) - 1)::INT AS position, page_id
              FROM lines JOIN ranges ON start = byte_offset),
            seen AS (SELECT stream_ordinal AS ordinal, (row_number() OVER (PARTITION BY stream_ordinal ORDER BY page_id) - 1)::INT AS position, page_id, true AS found
              FROM (SELECT DISTINCT stream_ordinal, page_id FROM page_decisions WHERE page_id IS NOT NULL AND stream_ordinal IS NOT NULL))
            SELECT ordinal, position, s.page_id, l.page_id AS expected_page_id FROM listed l FULL JOIN seen s USING (ordinal, position)
            WHERE s.found IS NULL OR l.page_id IS NULL OR s.page_id <> l.page_id""",
        "ledger_against_ranges": f"""WITH {_SEGMENTS}, seen AS (SELECT stream_ordinal AS ordinal, count(*) AS pages_seen FROM (SELECT DISTINCT * FROM page_decisions)
              WHERE stream_ordinal IS NOT NULL GROUP BY stream_ordinal)
            SELECT ordinal, pages_seen, pages FROM seen FULL JOIN (SELECT ordinal, pages FROM ranges) USING (ordinal) WHERE pages_seen IS DISTINCT FROM pages""",
        "decision_multiset": """WITH l AS (SELECT page_id, count(*) AS n FROM page_decisions GROUP BY page_id), r AS (SELECT page_id, count(*) AS n FROM segment_index GROUP BY page_id)
            SELECT coalesce(l.page_id, r.page_id) AS page_id, coalesce(l.n, 0)::BIGINT AS left_rows, coalesce(r.n, 0)::BIGINT AS right_rows
            FROM l FULL JOIN r ON l.page_id IS NOT DISTINCT FROM r.page_id WHERE coalesce(l.n, 0) <> coalesce(r.n, 0)""",
        "documents_in_order": """SELECT page_id, (row_number() OVER (ORDER BY page_id) - 1)::BIGINT AS place, lag(page_id) OVER (ORDER BY page_id) AS before
            FROM (SELECT DISTINCT page_id FROM wiki_documents WHERE page_id IS NOT NULL)""",
        "dropped_scan": f"""SELECT page_id, reason, title FROM (SELECT {page} AS page_id, title, CASE
            WHEN {page} IS NULL OR {space} IS NULL OR coalesce(title, '') = '' THEN 'invalid_page' WHEN {space} <> 0 THEN 'non_article_namespace'
            WHEN redirect IS NOT NULL THEN 'redirect' WHEN revision IS NULL OR {revision} IS NULL THEN 'invalid_page'
            WHEN regexp_matches(lower(coalesce(revision.text, '')), '^\\s*#redirect') THEN 'redirect' END AS reason FROM dump_pages) WHERE reason IS NOT NULL""",
        "shard_files": f"""WITH {_TOKENS}, flat_sizes AS (SELECT split, sequence // {PER_SHARD} AS shard, sequence,
              list_max(list_transform(tokens, lambda t: CASE WHEN t = '{END}' THEN 0 ELSE length(t) END)) AS largest FROM packed)
            SELECT split, shard::BIGINT AS shard, count(*) AS sequences, max(largest)::BIGINT AS largest FROM flat_sizes GROUP BY split, shard""",
        "shard_scan": f"""WITH {_TOKENS} SELECT split, (sequence // {PER_SHARD})::BIGINT AS shard, (sequence % {PER_SHARD})::BIGINT AS sequence,
            sha256(array_to_string(list_transform(tokens, lambda t: CASE WHEN t = '{END}' THEN 0 ELSE length(t) END), ' ')) AS tokens_sha256 FROM packed""",
        "attribution_digest": f"""WITH held AS (SELECT DISTINCT sha256({_json_row(ATTRIBUTION_COLUMNS)}) AS h FROM wiki_documents),
            blocks AS (SELECT substr(h, 1, 4) AS block, count(*) AS n, sha256(string_agg(h, '' ORDER BY h)) AS digest FROM held GROUP BY 1)
            SELECT count(*) AS blocks, sum(n)::BIGINT AS "rows", sha256(string_agg(digest, '' ORDER BY block)) AS corpus_sha256 FROM blocks""",
        "drop_counts": f"""SELECT reason, coalesce(n, 0) AS pages FROM {reasons} LEFT JOIN (SELECT reason, count(*) AS n FROM
            (SELECT DISTINCT * FROM page_decisions WHERE decision = 'dropped') GROUP BY reason) USING (reason)""",
        "accounting": """SELECT stream_ordinal, count(*) AS pages_seen, count(*) FILTER (decision = 'emitted') AS emitted, count(*) FILTER (decision = 'dropped') AS dropped,
            count(*) - count(*) FILTER (decision = 'emitted') - count(*) FILTER (decision = 'dropped') AS unaccounted FROM (SELECT DISTINCT * FROM page_decisions) GROUP BY stream_ordinal""",
        "decision_problems": f"""WITH found AS (
              SELECT page_id, stream_ordinal, 'unknown_decision' AS problem FROM page_decisions WHERE coalesce(decision, '') NOT IN ('emitted', 'dropped')
              UNION ALL SELECT page_id, stream_ordinal, 'emitted_with_reason' FROM page_decisions WHERE decision = 'emitted' AND reason IS NOT NULL
              UNION ALL SELECT page_id, stream_ordinal, 'dropped_without_reason' FROM page_decisions WHERE decision = 'dropped' AND reason IS NULL
              UNION ALL SELECT page_id, stream_ordinal, 'unknown_reason' FROM page_decisions WHERE reason NOT IN (SELECT reason FROM {reasons})
              UNION ALL SELECT page_id, stream_ordinal, 'no_page' FROM page_decisions WHERE page_id IS NULL
              UNION ALL SELECT page_id, NULL, 'repeated' FROM page_decisions WHERE page_id IS NOT NULL GROUP BY page_id HAVING count(*) > 1)
            SELECT page_id, stream_ordinal, problem, count(*) AS "rows" FROM found GROUP BY ALL""",
        "decisions_against_index": """SELECT page_id, 'decisions' AS only_in FROM (SELECT page_id FROM page_decisions EXCEPT SELECT page_id FROM segment_index) WHERE page_id IS NOT NULL
            UNION ALL SELECT page_id, 'index' FROM (SELECT page_id FROM segment_index EXCEPT SELECT page_id FROM page_decisions) WHERE page_id IS NOT NULL""",
        "decisions_against_documents": """WITH d AS (SELECT page_id FROM page_decisions WHERE decision = 'emitted')
            SELECT page_id, 'decisions' AS only_in FROM (SELECT page_id FROM d EXCEPT SELECT page_id FROM wiki_documents) WHERE page_id IS NOT NULL
            UNION ALL SELECT page_id, 'documents' FROM (SELECT page_id FROM wiki_documents EXCEPT SELECT page_id FROM d) WHERE page_id IS NOT NULL""",
        "page_decisions": "SELECT DISTINCT * FROM page_decisions WHERE decision IN ('emitted', 'dropped')",
        "segment_ranges": f"WITH {_SEGMENTS} SELECT * FROM ranges",
        "segment_pages": f"""WITH {_SEGMENTS} SELECT ordinal, (row_number() OVER (PARTITION BY byte_offset ORDER BY page_id) - 1)::INT AS position, page_id
            FROM lines JOIN ranges ON start = byte_offset""",
        "index_lines": "SELECT byte_offset, page_id, title FROM segment_index",
        "index_problems": """WITH good AS (SELECT DISTINCT byte_offset, page_id FROM segment_index WHERE byte_offset IS NOT NULL AND page_id IS NOT NULL),
            held AS (SELECT *, max(byte_offset) OVER (ORDER BY page_id RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM good),
            found AS (SELECT 'malformed' AS problem, page_id, byte_offset FROM segment_index WHERE byte_offset IS NULL OR page_id IS NULL
              UNION ALL SELECT 'negative', page_id, byte_offset FROM segment_index WHERE byte_offset < 0 OR page_id < 0
              UNION ALL SELECT 'repeated', page_id, NULL FROM segment_index WHERE page_id IS NOT NULL GROUP BY page_id HAVING count(*) > 1
              UNION ALL SELECT 'backwards', page_id, byte_offset FROM held WHERE byte_offset < before)
            SELECT problem, page_id, byte_offset, count(*) AS lines FROM found GROUP BY ALL""",
        "range_problems": f"""WITH {_SEGMENTS}, seen AS (SELECT ordinal, start, "end", lag("end") OVER (ORDER BY ordinal) AS before, row_number() OVER (ORDER BY ordinal) - 1 AS n FROM ranges)
            SELECT ordinal, 'empty' AS problem FROM seen WHERE "end" < start UNION ALL SELECT ordinal, 'gap' FROM seen WHERE start <> before + 1
            UNION ALL SELECT ordinal, 'not_dense' FROM seen WHERE ordinal <> n""",
        "remaining_segments": f"""WITH {_SEGMENTS} SELECT ordinal, first_page_id, pages FROM ranges
            WHERE ordinal NOT IN (SELECT stream_ordinal FROM page_decisions WHERE stream_ordinal IS NOT NULL)""",
        "residual_markup": f"SELECT id, array_to_string({_residue_sql()}, ',') AS kinds FROM {raw} WHERE text IS NOT NULL AND len({_residue_sql()}) > 0",
        "residue_report": f"""WITH hit AS (SELECT DISTINCT {_INT.format('id')} AS page_id, text FROM {raw} WHERE text IS NOT NULL AND len({_residue_sql()}) > 0)
            SELECT count(*) AS texts, array_to_string(list_slice(list_sort(list_distinct(list(page_id) FILTER (page_id IS NOT NULL))), 1, 20), ',') AS first_pages FROM hit""",
        "section_skip": f"""WITH pages AS (SELECT id, text, row_number() OVER () AS r FROM {raw} WHERE text IS NOT NULL),
            lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n FROM pages),
            levels AS (SELECT *, least(6, CASE WHEN length(regexp_extract(line, '^=*')) = length(line) THEN length(line) // 2
                              ELSE least(length(regexp_extract(line, '^=*')), length(regexp_extract(line, '=*$'))) END) AS level FROM lines),
            titled AS (SELECT *, regexp_replace(substr(line, level + 1, length(line) - 2 * level), '^\\s+|\\s+$', '', 'g') AS title FROM levels),
            hiding AS (SELECT r, n, level FROM titled WHERE level > 0 AND regexp_replace(lower(title), ':+$', '') IN {BOILERPLATE_HEADINGS}),
            spans AS (SELECT h.r, h.n AS first, coalesce(min(t.n), 1000000000) AS after FROM hiding h LEFT JOIN titled t
                      ON t.r = h.r AND t.n > h.n AND t.level > 0 AND t.level <= h.level GROUP BY h.r, h.n),
            kept AS (SELECT r, string_agg(CASE WHEN level > 0 THEN title ELSE line END, chr(10) ORDER BY n) AS text FROM titled t
                     WHERE NOT EXISTS (SELECT 1 FROM spans s WHERE s.r = t.r AND t.n >= s.first AND t.n < s.after) GROUP BY r)
            SELECT id, sha256(coalesce(k.text, '')) AS kept_sha256 FROM pages LEFT JOIN kept k USING (r)""",
        "collapsed_text": r"""SELECT DISTINCT page_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\r\n|\r', chr(10), 'g'),
            '[\t\f\v ]+', ' ', 'g'), '(?m)^ | $', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g')) AS collapsed_sha256
            FROM wiki_documents WHERE text IS NOT NULL""",
        "composed_text": "SELECT DISTINCT page_id, sha256(nfc_normalize(text)) AS composed_sha256 FROM wiki_documents WHERE page_id IS NOT NULL AND text IS NOT NULL",
        "row_digests": f"SELECT page_id, revision_id, sha256({_ROW}) AS row_sha256 FROM wiki_documents",
        "corpus_digest": f"""WITH held AS (SELECT DISTINCT sha256({_ROW}) AS h FROM wiki_documents),
            blocks AS (SELECT substr(h, 1, 4) AS block, count(*) AS n, sha256(string_agg(h, '' ORDER BY h)) AS digest FROM held GROUP BY 1)
            SELECT count(*) AS blocks, sum(n)::BIGINT AS "rows", sha256(string_agg(digest, '' ORDER BY block)) AS corpus_sha256 FROM blocks""",
        "token_pack": f"WITH {_TOKENS} SELECT split, sequence, (sequence // {PER_SHARD})::BIGINT AS shard, sha256(array_to_string(tokens, ' ')) AS tokens_sha256 FROM packed",
        "token_shards": f"WITH {_TOKENS} SELECT split, (sequence // {PER_SHARD})::BIGINT AS shard, count(*) AS sequences FROM packed GROUP BY split, sequence // {PER_SHARD}",
        "dropped_tails": f"WITH {_TOKENS} SELECT split, tokens, (tokens // {LENGTH})::BIGINT AS sequences, tokens % {LENGTH} AS dropped_tail_tokens FROM totals",
        "bigram_loss": f"""WITH {_TOKENS}, seq AS (SELECT unnest(tokens) AS token, unnest(range({LENGTH})) AS p FROM packed WHERE split = 'train' AND sequence = 0),
            pairs AS (SELECT token AS i, lead(token) OVER (ORDER BY p) AS j FROM seq), c AS (SELECT i, j, count(*)::DOUBLE AS c FROM pairs WHERE j IS NOT NULL GROUP BY i, j),
            v AS (SELECT count(DISTINCT token)::DOUBLE AS v FROM seq), n AS (SELECT i, sum(c) AS n, count(*) AS k FROM c GROUP BY i), t AS (SELECT sum(c) AS t FROM c),
            logits AS (SELECT c.i, c, n, k, v, t, (c - n / v) / t AS logit FROM c JOIN n USING (i), v, t),
            lse AS (SELECT i, ln(sum(exp(logit)) + max((v - k) * exp(-n / (v * t)))) AS lse FROM logits GROUP BY i)
            SELECT sum(c)::BIGINT AS token_pairs, max(v)::BIGINT AS observed_vocabulary, round(ln(max(v)), 9) AS loss_before,
                   round(-sum(c * (logit - lse)) / max(t), 9) AS loss_after FROM logits JOIN lse USING (i)""",
        "latest_revisions": """SELECT page_id, revision_id, snapshot_id, deliveries FROM (SELECT page_id, revision_id, snapshot_id, count(*) OVER (PARTITION BY page_id) AS deliveries,
              row_number() OVER (PARTITION BY page_id ORDER BY snapshot_id DESC NULLS LAST, revision_id DESC NULLS LAST) AS n
              FROM (SELECT DISTINCT page_id, revision_id, snapshot_id FROM page_arrivals WHERE page_id IS NOT NULL)) WHERE n = 1""",
        "snapshot_arrivals": """SELECT snapshot_id, count(*) AS deliveries, count(DISTINCT page_id) AS pages, count(*) FILTER (arrived_at IS NULL) AS undated,
            count(*) FILTER (arrived_at >= strptime(snapshot_id, '%Y%m%d') + INTERVAL 3 DAY) AS late FROM page_arrivals WHERE snapshot_id IS NOT NULL GROUP BY snapshot_id""",
    }
