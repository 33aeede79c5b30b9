"""Operators restated in DuckDB SQL, by their definitions instead of their methods."""

from __future__ import annotations

from haulback.llm import quality, url_filter
from haulback.llm.jaccard import Settings as JaccardSettings
from haulback.llm.substrings import WINDOW
from haulback.llm.suffixes import LENGTH
from haulback.llm.url_filter import Rule

WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def url_sql(rules: tuple[Rule, ...]) -> str:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = _LOWER.format(f"coalesce(regexp_extract(url, '{pattern}', 1), '')")
    hits = lambda terms: " + ".join(
        f"regexp_matches(lower(coalesce(url, '')), '(^|[^\\p{{L}}\\p{{N}}]){t}($|[^\\p{{L}}\\p{{N}}])')::INT" for t in terms
    )
    values = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in rules)
    return f"""WITH rules(v, h, p) AS (VALUES {values}),
    parts AS (SELECT page_id, {host} AS host,
        coalesce(regexp_extract(url, '{pattern}', 2), '') AS path,
        ({hits(url_filter.STRICT_TERMS)})::INT AS n_strict,
        ({hits(url_filter.SOFT_TERMS)})::INT AS n_soft FROM pages),
    judged AS (SELECT *, (SELECT arg_max(h || p || '|' || v, length(h || p)) FROM rules
        WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, p)) AS best FROM parts)
    SELECT page_id, host, path, split_part(best, '|', 1) AS rule,
        coalesce(split_part(best, '|', 2), CASE WHEN n_strict > 0 OR n_soft > 1
            THEN 'block' ELSE 'allow' END) AS verdict, n_strict, n_soft FROM judged"""


def passages_sql(window: int = WINDOW) -> str:
    """A word goes if one of the windows that start up to ``window`` - 1 words before it is a later
    one of its kind."""
    return f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words
        FROM documents),
    windows AS (SELECT doc_id, i, md5(array_to_string(words[i:i + {window - 1}], ' ')) AS k
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {window - 2})) AS i FROM w)),
    later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (
        PARTITION BY k ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
    places AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
    marked AS (SELECT p.doc_id, word, p.i AS i, coalesce(max(l.i) OVER (PARTITION BY p.doc_id
        ORDER BY p.i ROWS UNBOUNDED PRECEDING) > p.i - {window}, false) AS gone
        FROM places p LEFT JOIN later l ON p.doc_id = l.doc_id AND p.i = l.i),
    texts AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed,
        string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM marked GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN texts USING (doc_id)"""


def strings_sql(length: int = LENGTH) -> str:
    """The same for bytes, two hexadecimal digits each."""
    return f"""WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    windows AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * length})) AS k
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {length - 1})) AS i FROM t)),
    later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (
        PARTITION BY k ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
    places AS (SELECT doc_id, substr(h, 2 * i + 1, 2) AS byte, i
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM t)),
    covered AS (SELECT p.doc_id, byte, p.i AS i, coalesce(max(l.i) OVER (PARTITION BY p.doc_id
        ORDER BY p.i ROWS UNBOUNDED PRECEDING) > p.i - {length}, false) AS gone
        FROM places p LEFT JOIN later l ON p.doc_id = l.doc_id AND p.i = l.i),
    marked AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (
        PARTITION BY doc_id ORDER BY i) AS opens FROM covered),
    texts AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
        string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS kept FROM marked GROUP BY doc_id)
    SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
        coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
    FROM t LEFT JOIN texts USING (doc_id)"""


def components_sql(settings: JaccardSettings = JaccardSettings()) -> str:
    k = settings.words
    return f"""WITH RECURSIVE w AS (SELECT doc_id,
        regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{WORD}') AS words FROM documents),
    shingles AS (SELECT DISTINCT doc_id, md5(array_to_string(words[i:i + {k - 1}], ' ')) AS s FROM (
        SELECT doc_id, words, unnest(range(1, greatest(len(words) - {k - 2}, 2))) AS i FROM w
        WHERE len(words) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b
        ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * c >= {settings.percent} * (x.n + y.n - c)),
    reached AS (SELECT doc_id, doc_id AS other FROM w
        UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
    SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
    FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id"""


def quality_sql(limits: quality.Limits = quality.Limits()) -> str:
    body = "coalesce(text, '')"
    # The classes are written for a regular expression between quotes.
    members = {k: v.replace("'", "''") for k, v in quality.CLASSES.items()}
    kinds = ", ".join(f"length(regexp_replace({body}, '[^{m}]+', '', 'g'))" for m in members.values())
    listed = ", ".join(f"'{w}'" for w in quality.COMMON_WORDS)
    symbols = "length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))"
    n = len(quality.CLASSES)
    half = lambda p, q: f"CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"
    distance = f"sqrt(greatest(0, sum({half('p', 'q')} + {half('q', 'p')}) / 2))"
    return f"""WITH base AS (SELECT doc_id, lang, {body} AS body, length({body}) AS chars,
        regexp_extract_all({body}, '{WORD}') AS words, [{kinds}] AS kinds FROM documents),
    lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT doc_id,
        unnest(string_split(body, chr(10))) AS line FROM base)
        WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
    grams AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (SELECT doc_id, i,
        array_to_string(words[i:i + 2], ' ') AS g FROM (SELECT doc_id, words,
        unnest(range(1, len(words) - 1)) AS i FROM base))),
    repeats AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat FROM grams, range(0, 3) t(j)
        WHERE n > 1 GROUP BY doc_id),
    classes AS (SELECT doc_id, lang, unnest(list_append(kinds, chars - list_sum(kinds)::BIGINT)) AS v,
        generate_subscripts(list_append(kinds, 0), 1) AS c, chars AS total FROM base),
    found AS (SELECT doc_id, lower(word) AS c, count(*) AS v FROM (SELECT doc_id,
        unnest(words) AS word FROM base) WHERE lower(word) IN ({listed}) GROUP BY ALL),
    common AS (SELECT doc_id, lang, c, coalesce(v, 0) AS v, len(words) AS total FROM base
        CROSS JOIN (SELECT unnest([{listed}]) AS c) LEFT JOIN found USING (doc_id, c)
        UNION ALL SELECT doc_id, lang, '', len(words) - coalesce(
            (SELECT sum(v) FROM found f WHERE f.doc_id = base.doc_id), 0), len(words) FROM base),
    sound AS (SELECT doc_id, lang, chars, len(words) AS n FROM base LEFT JOIN repeats USING (doc_id)
        WHERE lang IS NOT NULL AND len(words) >= {limits.min_words}
        AND 100 * coalesce(n_repeat, 0) <= {limits.max_repeat_pct} * len(words)
        AND 100 * {symbols} <= {limits.max_reference_symbols_pct} * chars),
    langs AS (SELECT lang FROM sound GROUP BY lang
        HAVING sum(chars) >= {limits.min_reference_chars} AND sum(n) > 0),
    ref_classes AS (SELECT c.lang, c.c, sum(c.v) / sum(c.total) AS q FROM classes c
        JOIN sound USING (doc_id) WHERE c.lang IN (SELECT lang FROM langs) GROUP BY c.lang, c.c),
    ref_common AS (SELECT c.lang, c.c, sum(c.v) / sum(c.total) AS q FROM common c
        JOIN sound USING (doc_id) WHERE c.lang IN (SELECT lang FROM langs) GROUP BY c.lang, c.c),
    class_far AS (SELECT doc_id, {distance} AS d FROM (SELECT doc_id, v / total AS p, q
        FROM classes JOIN ref_classes USING (lang, c) WHERE total > 0) GROUP BY doc_id),
    word_far AS (SELECT doc_id, {distance} AS d FROM (SELECT doc_id, v / total AS p, q
        FROM common JOIN ref_common USING (lang, c) WHERE total >= {limits.min_compared_words})
        GROUP BY doc_id),
    counts AS (SELECT doc_id, len(words) AS n_words, chars - kinds[{n}] AS word_chars,
        {symbols} AS n_symbols,
        coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
        coalesce(c.d > {limits.max_class_distance}
            + {limits.class_distance_room} / sqrt(nullif(len(words), 0)), false)
        OR coalesce(w.d > {limits.max_word_distance}
            + {limits.word_distance_room} / sqrt(nullif(len(words), 0)), false) AS far
        FROM base LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
        LEFT JOIN class_far c USING (doc_id) LEFT JOIN word_far w USING (doc_id))
    SELECT * EXCLUDE (far), n_words < {limits.min_words}
            OR 100 * n_repeat_words > {limits.max_repeat_pct} * n_words AS base_failed,
        NOT base_failed AND NOT far AS kept FROM counts"""


def audit_sql() -> str:
    """Every document against every order of the filters, step by step."""
    letters = "(SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS {0})"
    fails = """CASE f WHEN 'A' THEN len(words) < 100
        WHEN 'B' THEN 100 * len(list_distinct(words)) < 80 * len(words)
        WHEN 'C' THEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body)
        WHEN 'D' THEN regexp_matches(body, '[#$%&*|]') ELSE d.doc_id > least_id END"""
    return f"""WITH said AS (SELECT doc_id, max(coalesce(quality, 0) = 1) AS good,
        max(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY doc_id),
    texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
        min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least_id FROM documents),
    judged AS (SELECT d.part, coalesce(s.good, false) AS good, coalesce(s.toxic, false) AS toxic,
        array_to_string(list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: coalesce({fails}, false)), '') AS failed
        FROM texts d LEFT JOIN said s ON s.doc_id = d.doc_id),
    cells AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good,
        count(*) FILTER (toxic) AS toxic FROM judged GROUP BY part, failed),
    orders AS (SELECT a || b || c || d || e AS filter_order FROM {letters.format("a")}, {letters.format("b")},
        {letters.format("c")}, {letters.format("d")}, {letters.format("e")}
        WHERE len(list_distinct([a, b, c, d, e])) = 5),
    steps AS (SELECT filter_order, step::INT AS step, filter_order[step] AS f, filter_order[:step - 1] AS earlier
        FROM orders, range(1, 6) t(step)),
    met AS (SELECT part, filter_order, step, f, n, good, toxic, contains(failed, f) AS here, failed = f AS alone,
        length(translate(failed, earlier, '')) < length(failed) AS gone FROM cells, steps),
    counted AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT gone AND NOT here), 0) AS kept,
        coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed,
        coalesce(sum(n) FILTER (here AND gone), 0) AS redundant,
        coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
        coalesce(sum(good) FILTER (here AND NOT gone), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (here AND NOT gone), 0) AS toxic_lost FROM met GROUP BY ALL)
    SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
        redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
        toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
    FROM counted"""


def infilling_sql() -> str:
    unit = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
    drawn = lambda i: f"('0x' || substr(h, {8 * i - 7}, 8))::BIGINT"
    joined = lambda a, b: f"array_to_string(units[{a}:{b}], '')"
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '{unit}') AS units,
        sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    cuts AS (SELECT doc_id, body, units, len(units) AS n, {drawn(1)} % (len(units) + 1) AS x,
        {drawn(2)} % (len(units) + 1) AS y, CASE WHEN body = '' OR contains(body, '<P>')
        OR contains(body, '<S>') OR contains(body, '<M>') OR {drawn(3)} % 100 >= 50 THEN 'plain'
        WHEN {drawn(4)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
    parts AS (SELECT *, {joined("1", "least(x, y)")} AS p,
        {joined("least(x, y) + 1", "greatest(x, y)")} AS m, {joined("greatest(x, y) + 1", "n")} AS s FROM cuts)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(body) AS restored_sha256 FROM parts"""
