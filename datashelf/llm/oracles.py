"""SQL with the same results as some of the registered queries, for DuckDB."""

from __future__ import annotations

from datashelf.llm.decontaminate import AROUND, MASKS, MIN_PERCENT, VERIFIED_WORDS
from datashelf.llm.secret_scan import BASE, RULES
from datashelf.llm.sentence_spans import SPAN_WORDS

SPAN = len(MASKS[0])
WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"


def _seeds(source: str, name: str) -> str:
    """Every seed of every row of ``source``: its words under each mask."""

    def under(number: int, mask: str) -> str:
        seen = ", ".join(f"w[pos + {i + 1}]" for i, c in enumerate(mask) if c == "1")
        return f"SELECT *, {number} AS mask, [{seen}] AS key FROM (SELECT *, unnest(range(len(w) - {SPAN - 1})) AS pos FROM {source} WHERE len(w) >= {SPAN})"

    return f"{name} AS ({' UNION ALL '.join(under(i, m) for i, m in enumerate(MASKS))})"


# Items of fewer words than a mask, which the test tables do not have, are left out.
SPACED_SEEDS = f"""WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
  b AS (SELECT w, min(item_id) AS item_id FROM (SELECT item_id, {WORDS} AS w FROM benchmark) GROUP BY w),
  {_seeds("d", "ds")}, {_seeds("b", "bs")},
  hits AS (SELECT ds.doc_id, bs.item_id, ds.w AS dw, bs.w AS bw, ds.pos AS p, bs.pos AS q, least({AROUND}, ds.pos, bs.pos) AS before,
    least({AROUND}, len(ds.w) - ds.pos - {SPAN}, len(bs.w) - bs.pos - {SPAN}) AS after FROM ds JOIN bs USING (mask, key)),
  looked AS (SELECT doc_id, item_id, p - before AS start, list_transform(list_zip(dw[p - before + 1 : p + {SPAN} + after],
    bw[q - before + 1 : q + {SPAN} + after]), lambda z: (z[1] = z[2])::INT) AS same FROM hits),
  summed AS (SELECT *, least(len(same), {VERIFIED_WORDS}) AS width FROM looked),
  scored AS (SELECT *, list_max(list_transform(range(1, len(same) - width + 2), lambda s: list_sum(same[s : s + width - 1]))) AS matched FROM summed),
  leaks AS (SELECT doc_id, item_id, min(start + list_position(same, 1) - 1) AS first, max(start + len(same) - list_position(list_reverse(same), 1)) AS last,
    max(matched) AS matched FROM scored WHERE matched * 100 >= width * {MIN_PERCENT} GROUP BY doc_id, item_id),
  told AS (SELECT doc_id, count(*) AS n_items, min(item_id) AS item_id, min(first) AS first_word, max(last) AS last_word, max(matched) AS matched
    FROM leaks GROUP BY doc_id)
  SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0)::BIGINT AS n_items, item_id, first_word::BIGINT AS first_word,
    last_word::BIGINT AS last_word, matched::INT AS matched FROM d LEFT JOIN told USING (doc_id)"""

PIECE = r"(?s).+?(?:[.!?,;:]+[ \t\n\r]+|[。！？，；：、।۔؟؛]+[ \t\n\r]*|\n[ \t\n\r]*|\z)"
SENTENCE_SPANS = rf"""WITH d AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{PIECE}') AS pieces FROM documents),
  units AS (SELECT doc_id, pos, trim(pieces[pos + 1], ' ' || chr(9) || chr(10) || chr(13)) AS unit
    FROM (SELECT *, unnest(range(len(pieces))) AS pos FROM d)),
  sized AS (SELECT *, greatest(len(regexp_extract_all(unit, '[^ \t\n\r\f\v]+')), 1) AS words FROM units),
  placed AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) - words AS start FROM sized),
  runs AS (SELECT doc_id, pos, list(unit) OVER run AS run, count(*) OVER run AS n, sum(words) OVER run AS words FROM placed
    WINDOW run AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND {SPAN_WORDS - 1} FOLLOWING)),
  later AS (SELECT doc_id, pos, n FROM runs WHERE words >= {SPAN_WORDS} OR pos = 0
    QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) > 1),
  gone AS (SELECT doc_id, list_distinct(flatten(list(range(pos, pos + n)))) AS gone FROM later GROUP BY doc_id),
  kept AS (SELECT d.*, gone IS NULL AS whole, list_filter(range(len(pieces)), lambda i: gone IS NULL OR NOT list_contains(gone, i)) AS left_over
    FROM d LEFT JOIN gone USING (doc_id)),
  cut AS (SELECT doc_id, text AS before, len(pieces) AS n, len(pieces) - len(left_over) AS removed,
    CASE WHEN whole THEN text ELSE array_to_string(list_transform(left_over, lambda i: pieces[i + 1]), '') END AS text FROM kept)
  SELECT doc_id, n::INT AS n_sentences, removed::INT AS n_removed, coalesce(length(before) - length(text), 0)::INT AS n_chars_removed, text FROM cut"""

NEAR_DUPLICATES = r"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
  sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i : i + 4]))) END AS s FROM d),
  groups AS (SELECT s, min(doc_id) AS node FROM sets WHERE len(s) > 0 GROUP BY s),
  shingles AS (SELECT node, len(s) AS n, unnest(s) AS x FROM groups),
  pairs AS (SELECT a.node AS a, b.node AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
    FROM shingles a JOIN shingles b ON a.x = b.x AND a.node < b.node GROUP BY a.node, b.node),
  links AS (SELECT a, b FROM pairs WHERE 100 * common >= 75 * (na + nb - common)),
  linked AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
  reach AS (SELECT node, node AS other FROM groups UNION SELECT reach.node, linked.b FROM reach JOIN linked ON reach.other = linked.a),
  classes AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
  SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, coalesce(component_id, sets.doc_id) AS component_id,
    coalesce(component_id, sets.doc_id) = sets.doc_id AS kept FROM sets LEFT JOIN groups USING (s) LEFT JOIN classes USING (node)"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _matches(number: int, rule) -> str:
    """Every match of a rule in every text: no index, no candidates."""
    pattern = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, {number} AS rule, '{rule.kind}' AS kind, {rule.least} AS least, regexp_split_to_array(text, '{pattern}') AS parts,
    regexp_extract_all(text, '{pattern}', 0) AS hits, regexp_extract_all(text, '{pattern}', {rule.group}) AS told FROM d"""


SECRETS = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
  tried AS ({" UNION ALL ".join(_matches(i, r) for i, r in enumerate(RULES))}),
  hits AS (SELECT doc_id, rule, kind, least, unnest(range(1, len(hits) + 1)) AS i, parts, hits, told FROM tried WHERE len(hits) > 0),
  each AS (SELECT *, length(parts[i]) AS before, length(hits[i]) AS size FROM hits),
  placed AS (SELECT *, sum(before + size) OVER (PARTITION BY doc_id, rule ORDER BY i) AS last FROM each),
  spans AS (SELECT doc_id, rule, kind, (last - size)::BIGINT AS first, concat_ws(':', kind, (last - size)::BIGINT, last::BIGINT) AS span
    FROM placed WHERE length(told[i]) >= least),
  told AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
    string_agg(span, ',' ORDER BY first, rule) FILTER (rule < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY first, rule) AS spans
    FROM spans GROUP BY doc_id)
  SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans FROM d LEFT JOIN told USING (doc_id)"""

PHRASES = rf"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
  totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
  runs AS (SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
    FROM words, (VALUES (1), (2), (3)) AS s(size) WHERE len(w) >= size),
  counts AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM runs GROUP BY lang, size, phrase),
  found AS (SELECT * FROM counts WHERE size > 1 AND f >= 10),
  cuts AS (SELECT *, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, size)) AS k FROM found)),
  scored AS (SELECT c.lang, c.phrase, c.f AS a, c.k, l.f AS l, r.f AS r, ((1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.x JOIN counts r ON r.lang = c.lang AND r.phrase = c.y),
  weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
  inside AS (SELECT lang, phrase, max(f) AS longer FROM (SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase
    FROM found WHERE size = 3) GROUP BY lang, phrase),
  standing AS (SELECT w.* FROM weakest w LEFT JOIN inside i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 50 * w.a),
  best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM standing)
  SELECT lang, rank, phrase, a, l, r, n, score FROM best JOIN totals USING (lang) WHERE rank <= 2000"""


def _crc_table() -> list[int]:
    """The remainders of CRC-32 for each byte."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return table


HEX = "'0123456789ABCDEF'"
CRC32 = f"""xor(list_reduce(list_transform(range(0, length(hex(feature)), 2), lambda i:
    ((instr({HEX}, hex(feature)[i + 1]) - 1) * 16 + instr({HEX}, hex(feature)[i + 2]) - 1)::BIGINT),
    lambda c, b: xor(c >> 8, {_crc_table()}[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"""

RESAMPLE = rf"""WITH texts AS (SELECT doc_id, {LOWER} AS text, false AS wanted FROM documents UNION ALL SELECT item_id, {LOWER}, true FROM benchmark),
  words AS (SELECT row_number() OVER () AS text_no, doc_id, wanted, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
  runs AS (SELECT text_no, wanted, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM words),
  held AS (SELECT text_no, wanted, feature, count(*) AS n FROM runs GROUP BY ALL),
  codes AS (SELECT feature, {CRC32} % 10000 AS bucket FROM (SELECT DISTINCT feature FROM held)),
  placed AS (SELECT text_no, wanted, bucket, sum(n)::BIGINT AS n FROM held JOIN codes USING (feature) GROUP BY ALL),
  counts AS (SELECT range AS bucket, coalesce(sum(n) FILTER (NOT wanted), 0) AS s, coalesce(sum(n) FILTER (wanted), 0) AS t
    FROM range(10000) LEFT JOIN placed ON placed.bucket = range GROUP BY range),
  gains AS (SELECT bucket, floor(1000 * ln((t + 1.0)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1.0)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts),
  weights AS (SELECT text_no, sum(n)::BIGINT AS n, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE NOT wanted GROUP BY text_no),
  scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[1:8])::BIGINT + 0.5)::DOUBLE / 4294967296::DOUBLE)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (text_no) WHERE NOT wanted),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
  SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM ranked"""

SQL = {
    "op3_sentence_spans": SENTENCE_SPANS,
    "op4_spaced_seeds": SPACED_SEEDS,
    "op10_minhash": NEAR_DUPLICATES,
    "op11_trigram_index": SECRETS,
    "op12_prefix_free": PHRASES,
    "op13_overlapped_scan": RESAMPLE,
}
