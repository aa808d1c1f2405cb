"""The check queries' results in SQL (DuckDB)."""

from vedrina.llm.entire_licenses import entire
from vedrina.llm.known_licenses import KNOWN, SPELLINGS

_WORD = r"'[^\x20\x09-\x0D]+'"

DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# The rules that reject beyond the base ones are written out in the column "junk".
QUALITY_SQL = rf"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), {_WORD}) AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, {_WORD})) AS lines
    FROM documents
), places AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 3
), seen AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM places
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM seen, (VALUES (0), (1), (2)) AS v(k) WHERE n > 1 GROUP BY doc_id
), measured AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           length(regexp_replace(text, '\P{{Lu}}', '', 'g')) * 2 > length(regexp_replace(text, '\P{{L}}', '', 'g')) AS shouting
    FROM split LEFT JOIN covered USING (doc_id)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           n_symbols * 10 > n_words * 3 OR n_dup_lines * 10 > n_lines * 6
           OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR shouting AS junk
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT junk AS kept
FROM judged
"""

# One block at a time would be the definition; here, too, the highest quotients are taken all at once, from all that a
# source or shard could get.
MIXING_SQL = rf"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS size,
           md5('0|' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS h
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS ordinal
    FROM sized GROUP BY source
), weighted AS (
    SELECT *, ([3, 1, 2])[((ordinal - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS bound FROM sources
), levels AS (
    SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(bound) OVER before, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM weighted
    WINDOW before AS (ORDER BY bound / weight, ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size, ordinal,
           coalesce(least(bound::DOUBLE, max(CASE WHEN level * weight <= bound THEN level END) OVER () * weight), bound::DOUBLE) AS target
    FROM levels
), numbered AS (
    SELECT *, CAST(round(sum(target) OVER () / 16) AS BIGINT) AS all_blocks FROM targets
), source_quotients AS (
    SELECT ordinal, target / (2 * k + 1) AS quotient, k, all_blocks
    FROM numbered, unnest(range(0, CAST(ceil(2 * target / 16) AS BIGINT) + 9)) AS t(k)
), source_quotas AS (
    SELECT ordinal, count(*) FILTER (r <= all_blocks) AS source_blocks
    FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, ordinal, k) AS r FROM source_quotients) GROUP BY ordinal
), placed AS (
    SELECT doc_id, size, source_size, target, t.ordinal, source_blocks, substr(h, 9) AS h,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) % greatest(1, least(4096, CAST(ceil(source_size / 65536) AS BIGINT))) AS shard
    FROM sized JOIN targets t ON sized.source IS NOT DISTINCT FROM t.source JOIN source_quotas USING (ordinal)
), shards AS (
    SELECT ordinal, shard, sum(size)::BIGINT AS shard_size, any_value(source_blocks) AS source_blocks
    FROM placed GROUP BY ALL HAVING sum(size) > 0
), shard_quotients AS (
    SELECT ordinal, shard, shard_size, source_blocks, shard_size / (2 * k + 1) AS quotient, k
    FROM (SELECT *, sum(shard_size) OVER (PARTITION BY ordinal) AS together FROM shards),
         unnest(range(0, CAST(ceil(2 * source_blocks * shard_size / together) AS BIGINT) + 9)) AS t(k)
), shard_quotas AS (
    SELECT ordinal, shard, shard_size, greatest(1, CAST(round(shard_size / 16) AS BIGINT)) AS n_blocks,
           count(*) FILTER (r <= source_blocks) AS won
    FROM (SELECT *, row_number() OVER (PARTITION BY ordinal ORDER BY quotient DESC, shard, k) AS r FROM shard_quotients)
    GROUP BY ALL
), passes AS (
    SELECT ordinal, shard, least(won, 2 * n_blocks) // n_blocks AS times,
           CAST(floor((least(won, 2 * n_blocks) % n_blocks) * shard_size / n_blocks) AS BIGINT) AS once_more
    FROM shard_quotas
), laid AS (
    SELECT *, sum(size) OVER (PARTITION BY ordinal, shard ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS so_far FROM placed
)
SELECT doc_id, size, source_size, target,
       CAST(coalesce(times * size + least(size, greatest(once_more - (so_far - size), 0)), 0) AS BIGINT) AS taken
FROM laid LEFT JOIN passes USING (ordinal, shard)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    blank = r"[ \t\n\r]"
    foundation = rf"copyright{blank}+\(c\){blank}+[0-9][0-9, \t\n\r-]*free{blank}+software{blank}+foundation,?{blank}+inc\.({blank}*<[^>\n]*>)?"
    dated = r"[^\p{L}\p{N}©\n]*(?:copyright[^\p{L}\p{N}\n]*(?:c[^\p{L}\p{N}\n]+)?[0-9]{4}|\(c\)[^\p{L}\p{N}\n]*[0-9]{4}|©)[^\n]*"
    claim = r"[^\p{L}\p{N}©\x22“\n]*(?:copyright|all rights reserved)[^\n]*"
    plain = f"regexp_replace(lower({text}), '{foundation}', ' ', 'g')"
    plain = f"regexp_replace({plain}, '(^|\\n)[^\\p{{L}}\\p{{N}}©]*\\n', chr(10) || chr(10), 'g')"
    plain = f"regexp_replace({plain}, '(?:(?:^|\\n){dated}|(?:^|\\n\\n){claim})(?:\\n+(?:{dated}|{claim}))*', ' ', 'g')"
    plain = f"' ' || regexp_replace({plain}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || ' '"
    for spelling, same_as in SPELLINGS:
        plain = f"replace({plain}, {_quoted(' ' + spelling.replace(' ', '  ') + ' ')}, {_quoted(' ' + same_as + ' ')})"
    return f"trim(regexp_replace({plain}, ' +', ' ', 'g'))"


def _known() -> list[tuple[str, str]]:
    """The list that the scan looks texts up in, each text once."""
    return list(dict.fromkeys((name, text) for listed in (KNOWN, entire()) for name, texts in listed.items() for text in texts))


LICENSE_SQL = f"""
WITH known AS (
    SELECT sha256({_canonical("t")}) AS digest, min(name) AS license
    FROM (VALUES {", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in _known())}) AS v(name, t)
    WHERE {_canonical("t")} <> '' GROUP BY 1
), split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, coalesce(text, '') AS text FROM documents
), units AS (
    SELECT doc_id, -1 AS line, text AS unit FROM split
    UNION ALL
    SELECT doc_id, i, lines[i + 1] FROM split, unnest(range(0, len(lines))) AS t(i)
), digests AS (
    SELECT doc_id, line, sha256({_canonical("unit")}) AS digest FROM units
)
SELECT doc_id, count(*) FILTER (line >= 0) AS n_lines, count(license) FILTER (line >= 0) AS n_matching_lines,
       coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses,
       bool_or(line = -1 AND license IS NOT NULL) AS is_license
FROM digests LEFT JOIN known USING (digest)
GROUP BY doc_id
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, terms, len(terms)::BIGINT AS n
    FROM (SELECT doc_id, {_TERMS} AS terms FROM documents) WHERE len(terms) > 0
), totals AS (
    SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM docs
), postings AS (
    SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, totals GROUP BY term, all_docs
), wanted AS (
    SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), scores AS (
    SELECT item_id, row, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * all_docs) // all_terms)))) AS BIGINT) AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""

LINES_SQL = """
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), placed AS (
    SELECT row, doc_id, lines, unnest(range(1, len(lines) + 1)) AS place FROM docs
), keyed AS (
    SELECT row, doc_id, place, lines[place] AS line,
           translate(trim(lines[place], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM placed
), common AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= 10
), marked AS (
    SELECT row, doc_id, place, line, key IN (SELECT key FROM common) AS dropped FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY row, doc_id
"""
