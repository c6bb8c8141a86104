"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from corpusmill.llm import budget, encode, garbled, mixing, near, overlap, packing, quality, sample
from corpusmill.runtime import table


def _two(spark, d):
    return budget.corpus_records(table(spark, d, "wiki_documents"), table(spark, d, "documents"))


def p1_sample(spark, d):
    return sample.sample_pages(table(spark, d, "wiki_documents"), table(spark, d, "page_arrivals"))


def p1_growth(spark, d):
    return sample.growth_by_snapshot(table(spark, d, "wiki_documents"), table(spark, d, "page_arrivals"))


def p2_tokens(spark, d):
    return budget.token_counts(_two(spark, d))


def p2_totals(spark, d):
    return budget.token_totals(_two(spark, d))


def p3_found(spark, d):
    return quality.not_prose(table(spark, d, "wiki_documents"))


def p3_statistics(spark, d):
    return quality.text_statistics(table(spark, d, "wiki_documents"))


def p4_containers(spark, d):
    return packing.pack_texts(table(spark, d, "wiki_documents"), table(spark, d, "container_sizes"))


def p4_fill(spark, d):
    sizes = table(spark, d, "container_sizes")
    return packing.container_fill(packing.pack_texts(table(spark, d, "wiki_documents"), sizes), sizes)


def p5_found(spark, d):
    return near.near_pages(table(spark, d, "wiki_documents"))


def p5_groups(spark, d):
    return near.duplicate_groups(table(spark, d, "wiki_documents"))


def p6_found(spark, d):
    return overlap.overlapping_pages(table(spark, d, "wiki_documents"))


def p6_overlaps(spark, d):
    return overlap.overlap_report(table(spark, d, "wiki_documents"))


def p7_ids(spark, d):
    return encode.encode_texts(table(spark, d, "documents"), "doc_id", "text")


def p8_mix(spark, d):
    return mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_shares(spark, d):
    targets = table(spark, d, "mix_targets")
    return mixing.mix_shares(mixing.mix_sources(table(spark, d, "documents"), targets), targets)


def p8_margins(spark, d):
    return mixing.mix_margins(mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets")))


def p9_found(spark, d):
    return garbled.garbled_documents(table(spark, d, "documents"))


def p9_restored(spark, d):
    return garbled.mend_texts(table(spark, d, "documents"))


def queries():
    """All queries of the subpackage by name."""
    return {f.__name__: f for f in (p1_sample, p1_growth, p2_tokens, p2_totals, p3_found, p3_statistics, p4_containers, p4_fill, p5_found, p5_groups, p6_found, p6_overlaps, p7_ids, p8_mix, p8_shares, p8_margins, p9_found, p9_restored)}


def oracle_sql():
    """SQL of the queries that SQL can express."""
    alike = """
            texts AS (SELECT DISTINCT page_id, text, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS words
                      FROM wiki_documents WHERE page_id IS NOT NULL AND text IS NOT NULL),
            classes AS (SELECT text, any_value(words) AS words, row_number() OVER (ORDER BY text) AS c
                        FROM texts WHERE len(words) >= 20 GROUP BY text),
            shingles AS (SELECT DISTINCT c, concat_ws(' ', words[i], words[i + 1], words[i + 2]) AS s
                         FROM (SELECT c, words, unnest(range(1, len(words) - 1)) AS i FROM classes)),
            sizes AS (SELECT c, count(*) AS n FROM shingles GROUP BY c),
            common AS (SELECT x.c AS a, y.c AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.c < y.c GROUP BY 1, 2),
            pairs AS (SELECT a, b FROM common JOIN sizes m ON m.c = a JOIN sizes n ON n.c = b WHERE k >= 0.6 * (m.n + n.n - k)),
            linked AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs)"""
    chosen = sample.chosen_sql("page_id", sample.DEFAULT_RATE)
    pages = "ids AS (SELECT DISTINCT page_id FROM wiki_documents WHERE page_id IS NOT NULL)"
    return {
        "p5_found": f"""
            WITH {alike}
            SELECT DISTINCT p.page_id AS page_id_a, q.page_id AS page_id_b
            FROM linked JOIN classes x ON x.c = a JOIN classes y ON y.c = b JOIN texts p ON p.text = x.text JOIN texts q ON q.text = y.text
            WHERE p.page_id < q.page_id""",
        "p6_found": f"""
            WITH {alike},
            splits AS (SELECT DISTINCT page_id, text, lower(trim(split)) AS split FROM wiki_documents
                       WHERE page_id IS NOT NULL AND regexp_matches(text, '\\S') AND lower(trim(split)) IN ('train', 'validation', 'test')),
            alike_texts AS (SELECT x.text AS text_a, y.text AS text_b FROM linked JOIN classes x ON x.c = a JOIN classes y ON y.c = b
                        UNION SELECT text, text FROM splits)
            SELECT DISTINCT least(p.page_id, q.page_id) AS page_id_a, greatest(p.page_id, q.page_id) AS page_id_b
            FROM alike_texts s JOIN splits p ON p.text = s.text_a JOIN splits q ON q.text = s.text_b
            WHERE p.page_id <> q.page_id AND p.split = 'train' AND q.split <> 'train'""",
        "p1_sample": f"""
            WITH {pages}, chosen AS ({chosen}),
            seen AS (SELECT page_id, min(snapshot_id) AS first_snapshot, count(*) AS deliveries
                     FROM (SELECT DISTINCT page_id, revision_id, snapshot_id, arrived_at FROM page_arrivals) GROUP BY page_id)
            SELECT c.id AS page_id, s.first_snapshot, coalesce(s.deliveries, 0)::BIGINT AS deliveries
            FROM chosen c LEFT JOIN seen s ON s.page_id = c.id""",
        "p1_growth": f"""
            WITH {pages}, chosen AS ({chosen}),
            first AS (SELECT page_id, min(snapshot_id) AS snapshot_id FROM page_arrivals
                      WHERE page_id IS NOT NULL AND snapshot_id IS NOT NULL GROUP BY page_id),
            per AS (SELECT f.snapshot_id, count(*) AS new_known, count(c.id) AS new_sampled
                    FROM ids i JOIN first f USING (page_id) LEFT JOIN chosen c ON c.id = i.page_id GROUP BY f.snapshot_id)
            SELECT snapshot_id, sum(new_known) OVER w ::BIGINT AS known, sum(new_sampled) OVER w ::BIGINT AS sampled,
                   new_known, new_sampled
            FROM per WINDOW w AS (ORDER BY snapshot_id)""",
    }
