"""The queries of `queries.py` in DuckDB's SQL, written apart from the DataFrame code as a check on it."""

from __future__ import annotations

# Fixed values, as in the cleaner: Unicode white space and the four ASCII separators; sentence ends; markup.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
BREAK = f"[?!.][{WHITESPACE}]+"
MARK = r"&[#0-9]+;|<[^>]+>|\[\[[^\]]+\]\]|[\r\n]+"
TOKENS = "regexp_extract_all(lower({0}), '[a-z0-9]+')"
LINES = f"regexp_replace(trim({{0}}, '{WHITESPACE}'), '([.!?])[{WHITESPACE}]+', '\\1' || chr(10), 'g')"
HASH = "('0x' || substr(md5('42:' || {0}), 1, 8))::BIGINT"
SPLIT = (
    f"CASE WHEN {HASH} / 4294967296.0 < 0.8 THEN 'train' WHEN {HASH} / 4294967296.0 < 0.9 THEN 'validation' "
    "ELSE 'test' END"
)
PAGES = (
    "SELECT page_id, regexp_extract(url, '://([^/]+)/', 1) AS product_id, "
    "regexp_extract(html, '<title>([^<]*)</title>', 1) AS review_headline, html AS review_body FROM pages"
)
ANSWERS = (
    "SELECT a.conv_id, a.turn, a.text AS prediction, u.text AS reference FROM conversations a "
    "JOIN conversations u ON u.conv_id = a.conv_id AND u.turn + 1 = a.turn "
    "WHERE a.role = 'assistant' AND u.role = 'user'"
)


def stripped(col: str) -> str:
    return f"trim({col}, '{WHITESPACE}')"


def unmarked(col: str) -> str:
    return stripped(f"regexp_replace({stripped(col)}, '{MARK}', ' ', 'g')")


def cut(source: str, key: str, col: str, budget: int, name: str) -> str:
    """CTEs up to `name`(key, text): `col` of `source` cut at a sentence end within the budget."""
    return f"""
      {name}_s AS (SELECT {key} AS k, {col} AS s FROM ({source})),
      {name}_l AS (SELECT k, regexp_split_to_array(s, '{BREAK}') AS p, regexp_extract_all(s, '{BREAK}') AS d
                   FROM {name}_s),
      {name}_u AS (SELECT k, unnest(p) AS f, 2 * generate_subscripts(p, 1) AS i FROM {name}_l
                   UNION ALL SELECT k, unnest(d), 2 * generate_subscripts(d, 1) + 1 FROM {name}_l),
      {name}_c AS (SELECT k, f, i, sum(len(string_split(f, ' '))) OVER (PARTITION BY k ORDER BY i) AS cost FROM {name}_u),
      {name} AS (SELECT k, coalesce({stripped(f"string_agg(f, '' ORDER BY i) FILTER (WHERE cost <= {budget})")}, '')
                 AS text FROM {name}_c GROUP BY k)"""


def cleaned(source: str, key: str, col: str, budget: int, name: str) -> str:
    return cut(f"SELECT {key}, {unmarked(col)} AS s FROM ({source})", key, "s", budget, name)


CLEAN_DOCUMENTS = f"""{cleaned("SELECT doc_id, text FROM documents", "doc_id", "text", 100, "clean")},
      docs AS (SELECT doc_id, source, c.text FROM documents JOIN clean c ON c.k = doc_id WHERE length(c.text) > 0)"""


def clean_pages(pages: str) -> str:
    return f"""WITH {cleaned(pages, "page_id", "review_headline", 20, "h")},
      {cleaned(pages, "page_id", "review_body", 100, "b")},
      reviews AS (SELECT page_id, product_id, h.text AS review_headline, b.text AS review_body
                  FROM ({pages}) JOIN h ON h.k = page_id JOIN b ON b.k = page_id
                  WHERE length(h.text) > 0 AND length(b.text) > 0)"""


CLEAN_PAGES = clean_pages(PAGES)
# Tabs and line breaks cannot stand in a field of a tab-separated file.
RAW_PAGES = clean_pages(PAGES.replace("html AS", "regexp_replace(html, '[\\t\\r\\n]+', ' ', 'g') AS"))


def vocab(source: str, size: int) -> str:
    return f"""
      counted AS (SELECT token, count(*) AS count FROM (SELECT unnest({TOKENS.format("text")}) AS token FROM {source})
                  GROUP BY token),
      vocab AS (SELECT token, (row_number() OVER (ORDER BY count DESC, token) + 2)::INTEGER AS id, count FROM counted
                QUALIFY row_number() OVER (ORDER BY count DESC, token) <= {size})"""


def ids(source: str, key: str, col: str, length: int, name: str) -> str:
    """CTEs up to `name`(k, ids): a list of ids that ends in 1."""
    return f"""
      {name}_t AS (SELECT {key} AS k, {TOKENS.format(col)}[1:{length - 1}] AS t FROM ({source})),
      {name}_u AS (SELECT k, unnest(t) AS token, generate_subscripts(t, 1) AS i FROM {name}_t),
      {name}_g AS (SELECT k, list(coalesce(id, 2) ORDER BY i) AS l FROM {name}_u LEFT JOIN vocab USING (token) GROUP BY k),
      {name} AS (SELECT t.k, list_append(coalesce(l, []), 1) AS ids FROM {name}_t t LEFT JOIN {name}_g g ON g.k = t.k)"""


def padded(col: str, length: str, pad: int) -> str:
    return f"list_concat({col}, list_resize([]::INTEGER[], greatest({length} - len({col}), 0)::BIGINT, {pad}))"


def joined(col: str) -> str:
    return f"array_to_string({col}, ',')"


PAIR_TOKENS = f"""
      pairs AS ({ANSWERS}),
      tokens AS (SELECT conv_id, turn, {TOKENS.format("prediction")} AS a, {TOKENS.format("reference")} AS b FROM pairs)"""
SHARES = """CASE WHEN p > 0 AND r > 0 THEN h / p ELSE 0 END AS precision,
      CASE WHEN p > 0 AND r > 0 THEN h / r ELSE 0 END AS recall,
      CASE WHEN p > 0 AND r > 0 THEN 2 * h / (p + r) ELSE 0 END AS f1"""


def gram_scores(n: int, name: str) -> str:
    """CTEs up to `name`(conv_id, turn, precision, recall, f1), after `tokens`."""
    gram = " || ' ' || ".join(f"t[i + {k}]" for k in range(n))
    return f"""
      {name}_i AS (SELECT conv_id, turn, 0 AS side, a AS t, unnest(range(1, len(a) - {n} + 2)) AS i FROM tokens
                   UNION ALL SELECT conv_id, turn, 1, b, unnest(range(1, len(b) - {n} + 2)) FROM tokens),
      {name}_g AS (SELECT conv_id, turn, {gram} AS g, count(*) FILTER (WHERE side = 0) AS p,
                   count(*) FILTER (WHERE side = 1) AS r FROM {name}_i GROUP BY ALL),
      {name}_s AS (SELECT conv_id, turn, sum(least(p, r))::DOUBLE AS h, sum(p)::DOUBLE AS p, sum(r)::DOUBLE AS r
                   FROM {name}_g GROUP BY ALL),
      {name} AS (SELECT conv_id, turn, {SHARES} FROM tokens LEFT JOIN {name}_s USING (conv_id, turn))"""


# The table of lengths row by row: with candidates c, the new row is the running maximum of c.
LCS_SCORES = f"""
      steps AS (SELECT conv_id, turn, 0 AS i, list_resize([]::INTEGER[], (len(b) + 1)::BIGINT, 0) AS r FROM tokens
                UNION ALL
                SELECT conv_id, turn, i, list_transform(range(1, len(c) + 1), lambda j: list_max(c[1:j])) FROM (
                  SELECT s.conv_id, s.turn, s.i + 1 AS i, list_transform(range(0, len(b) + 1), lambda j:
                    CASE WHEN j = 0 THEN 0 WHEN b[j] = a[s.i + 1] THEN r[j] + 1 ELSE r[j + 1] END) AS c
                  FROM steps s JOIN tokens t ON t.conv_id = s.conv_id AND t.turn = s.turn WHERE s.i < len(a))),
      lengths AS (SELECT t.conv_id, t.turn, s.r[len(b) + 1]::DOUBLE AS h, len(a)::DOUBLE AS p, len(b)::DOUBLE AS r
                  FROM tokens t JOIN steps s ON s.conv_id = t.conv_id AND s.turn = t.turn AND s.i = len(a)),
      lcs AS (SELECT conv_id, turn, {SHARES} FROM lengths)"""


def sentence_tokens(col: str, number: str, name: str) -> str:
    """One row per sentence of `col` that has a token: its number and tokens."""
    lists = f"list_transform(string_split({LINES.format(col)}, chr(10)), lambda x: {TOKENS.format('x')})"
    return f"""SELECT conv_id, turn, generate_subscripts(l, 1) AS {number}, unnest(l) AS {name}
        FROM (SELECT conv_id, turn, list_filter({lists}, lambda x: len(x) > 0) AS l FROM pairs)"""


# Each reference sentence r against each predicted one p: the table of lengths by rows, then the walk back through it.
UNION_LCS = """
      duos AS (SELECT conv_id, turn, rk, pk, r, p FROM rs JOIN ps USING (conv_id, turn)),
      steps AS (SELECT conv_id, turn, rk, pk, 0 AS i, list_resize([]::INTEGER[], (len(p) + 1)::BIGINT, 0) AS t FROM duos
                UNION ALL
                SELECT conv_id, turn, rk, pk, i, list_transform(range(1, len(c) + 1), lambda j: list_max(c[1:j])) FROM (
                  SELECT conv_id, turn, rk, pk, s.i + 1 AS i, list_transform(range(0, len(p) + 1), lambda j:
                    CASE WHEN j = 0 THEN 0 WHEN p[j] = r[s.i + 1] THEN t[j] + 1 ELSE t[j + 1] END) AS c
                  FROM steps s JOIN duos USING (conv_id, turn, rk, pk) WHERE s.i < len(r))),
      walk AS (SELECT conv_id, turn, rk, pk, len(r)::INTEGER AS i, len(p)::INTEGER AS j, NULL::INTEGER AS hit FROM duos
               UNION ALL
               SELECT conv_id, turn, rk, pk, CASE WHEN taken OR NOT back THEN i - 1 ELSE i END,
                 CASE WHEN taken OR back THEN j - 1 ELSE j END, CASE WHEN taken THEN i END FROM (
                 SELECT w.conv_id, w.turn, w.rk, w.pk, w.i, w.j, r[w.i] = p[w.j] AS taken, here.t[w.j] > above.t[w.j + 1] AS back
                 FROM walk w JOIN duos USING (conv_id, turn, rk, pk)
                 JOIN steps here ON here.conv_id = w.conv_id AND here.turn = w.turn AND here.rk = w.rk
                   AND here.pk = w.pk AND here.i = w.i
                 JOIN steps above ON above.conv_id = w.conv_id AND above.turn = w.turn AND above.rk = w.rk
                   AND above.pk = w.pk AND above.i = w.i - 1
                 WHERE w.i > 0 AND w.j > 0)),
      covered AS (SELECT conv_id, turn, r[hit] AS token, count(*) AS n FROM
                  (SELECT DISTINCT conv_id, turn, rk, hit FROM walk WHERE hit IS NOT NULL)
                  JOIN rs USING (conv_id, turn, rk) GROUP BY ALL),
      available AS (SELECT conv_id, turn, token, count(*) AS m FROM
                    (SELECT conv_id, turn, unnest(p) AS token FROM ps) GROUP BY ALL),
      hits AS (SELECT conv_id, turn, sum(least(n, m))::DOUBLE AS h
               FROM covered JOIN available USING (conv_id, turn, token) GROUP BY ALL)"""
ROUGE_LSUM = f"""WITH RECURSIVE pairs AS ({ANSWERS}),
      ps AS ({sentence_tokens("prediction", "pk", "p")}),
      rs AS ({sentence_tokens("reference", "rk", "r")}), {UNION_LCS},
      sizes AS (SELECT conv_id, turn, len({TOKENS.format("prediction")})::DOUBLE AS p,
                len({TOKENS.format("reference")})::DOUBLE AS r FROM pairs),
      summed AS (SELECT conv_id, turn, coalesce(h, 0) AS h, p, r FROM sizes LEFT JOIN hits USING (conv_id, turn))
      SELECT conv_id, turn, {SHARES} FROM summed"""


# Word stems over distinct words, a step after the other (Porter 1980 with the later changes). Words are taken as strings of
# C and V first: `y` is V after a letter that is no vowel letter. The suffixes and words of the published rules.
def shape(w: str) -> str:
    y = f"regexp_replace(regexp_replace({w}, '^y', 'C'), '([aeiou])y', '\\1C', 'g')"
    return f"regexp_replace(regexp_replace({y}, '[aeiouy]', 'V', 'g'), '[^CV]', 'C', 'g')"


def without(w: str, n: int) -> str:
    return f"{w}[1:len({w}) - {n}]"


def closed(w: str) -> str:
    return f"((regexp_matches({shape(w)}, 'CVC$') AND NOT regexp_matches({w}, '[wxy]$')) OR {shape(w)} = 'VC')"


ONE, TWO, JUST_ONE = "VC", "VC+V+C", "^C*V+C+V*$"
SUFFIXES_2 = """ational ate tional tion enci ence anci ance izer ize bli ble alli al entli ent eli e ousli ous ization ize ation ate ator ate
    alism al iveness ive fulness ful ousness ous aliti al iviti ive biliti ble fulli ful logi log"""
SUFFIXES_3 = "icate ic ative - alize al iciti ic ical ic ful - ness -"
SUFFIXES_4 = "al - ance - ence - er - ic - able - ible - ant - ement - ment - ent - ion - ou - ism - ate - iti - ous - ive - ize -"
OWN_STEMS = """sky sky skies sky dying die lying lie tying tie news news innings inning inning inning outings outing outing outing
    cannings canning canning canning howe howe proceed proceed exceed exceed succeed succeed"""


def suffix_step(w: str, rules: str, measure: str) -> str:
    """The longest suffix that fits gives way if the stem before it is long enough."""
    pairs = list(zip(rules.split()[::2], rules.split()[1::2], strict=True))
    cases = ""
    for suffix, news in sorted(pairs, key=lambda pair: -len(pair[0])):
        stem = without(w, len(suffix))
        long_enough = f"regexp_matches({shape(without(w, len(suffix) - 1) if suffix == 'logi' else stem)}, '{measure}')"
        if suffix == "ion":
            long_enough += f" AND regexp_matches({stem}, '[st]$')"
        cases += f" WHEN ends_with({w}, '{suffix}') THEN CASE WHEN {long_enough} THEN {stem} || '{news.replace('-', '')}' ELSE {w} END"
    return f"CASE{cases} ELSE {w} END"


def stems(source: str) -> str:
    """CTEs up to `stemmed`(token, stem): distinct tokens of `source`, those of more than three letters as stems."""
    own = OWN_STEMS.split()
    steps = [
        f"CASE WHEN regexp_matches(w, '^.ies$') THEN {without('w', 1)} WHEN regexp_matches(w, '(sses|ies)$') THEN {without('w', 2)} "
        f"WHEN regexp_matches(w, '[^s]s$|^s$') THEN {without('w', 1)} ELSE w END",
        # What is left when a past or present ending goes is mended in the next step; an upper-case mark tells it.
        f"CASE WHEN regexp_matches(w, '^.ied$') THEN {without('w', 1)} WHEN ends_with(w, 'ied') THEN {without('w', 2)} "
        f"WHEN ends_with(w, 'eed') THEN CASE WHEN regexp_matches({shape(without('w', 3))}, '{ONE}') THEN {without('w', 1)} ELSE w END "
        f"WHEN ends_with(w, 'ed') AND contains({shape(without('w', 2))}, 'V') THEN {without('w', 2)} || '!' "
        f"WHEN ends_with(w, 'ing') AND contains({shape(without('w', 3))}, 'V') THEN {without('w', 3)} || '!' ELSE w END",
        f"CASE WHEN NOT ends_with(w, '!') THEN w WHEN regexp_matches(w, '(at|bl|iz)!$') THEN {without('w', 1)} || 'e' "
        f"WHEN w[-2:-2] = w[-3:-3] AND ends_with({shape(without('w', 2))}, 'C') THEN CASE WHEN regexp_matches(w, '[^lsz]!$') THEN {without('w', 2)} ELSE {without('w', 1)} END "
        f"WHEN regexp_matches({shape(without('w', 1))}, '{JUST_ONE}') AND {closed(without('w', 1))} THEN {without('w', 1)} || 'e' ELSE {without('w', 1)} END",
        f"CASE WHEN ends_with(w, 'y') AND regexp_matches({shape(without('w', 1))}, '.C$') THEN {without('w', 1)} || 'i' ELSE w END",
        f"CASE WHEN ends_with(w, 'alli') AND regexp_matches({shape(without('w', 4))}, '{ONE}') THEN {without('w', 2)} ELSE w END",
        suffix_step("w", SUFFIXES_2, ONE),
        suffix_step("w", SUFFIXES_3, ONE),
        suffix_step("w", SUFFIXES_4, TWO),
        f"CASE WHEN ends_with(w, 'e') AND (regexp_matches({shape(without('w', 1))}, '{TWO}') OR (regexp_matches({shape(without('w', 1))}, '{JUST_ONE}') "
        f"AND NOT {closed(without('w', 1))})) THEN {without('w', 1)} ELSE w END",
        f"CASE WHEN ends_with(w, 'll') AND regexp_matches({shape(without('w', 1))}, '{TWO}') THEN {without('w', 1)} ELSE w END",
    ]
    ctes = [f"step0 AS (SELECT DISTINCT token, token AS w FROM ({source}))"]
    ctes += [f"step{i + 1} AS (SELECT token, {step} AS w FROM step{i})" for i, step in enumerate(steps)]
    listed = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in zip(own[::2], own[1::2], strict=True))
    return ",\n".join([*ctes, f"stemmed AS (SELECT token, CASE WHEN length(token) <= 3 THEN token ELSE CASE token {listed} ELSE w END END AS stem FROM step{len(steps)})"])


# A piece between white space as in the sentence learner: opening marks, the word, a full stop.
WORD = r"^[^\p{L}\p{N}]*([\p{L}\p{N}](?:[\p{L}\p{N}.''-]*[\p{L}\p{N}])?)(\.?)"
WORD_TYPES = f"""
      pieces AS (SELECT doc_id, unnest(l) AS p, generate_subscripts(l, 1) AS i FROM
                 (SELECT doc_id, list_filter(regexp_split_to_array({stripped('text')}, '[{WHITESPACE}]+'), lambda x: x <> '') AS l FROM documents)),
      pieces_w AS (SELECT regexp_extract(p, '{WORD}', 1) AS w, regexp_extract(p, '{WORD}', 2) = '.' AS stop,
                   lag(p) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM pieces),
      types AS (SELECT lower(w) AS word, count(*) FILTER (WHERE stop) AS n_stop, count(*) FILTER (WHERE NOT stop) AS n_other,
                count(*) FILTER (WHERE regexp_matches(w, '^\\p{{Ll}}')) AS n_small,
                count(*) FILTER (WHERE regexp_matches(w, '^\\p{{Lu}}') AND NOT regexp_matches(b, '[.!?:][^\\p{{L}}\\p{{N}}]*$')) AS n_large
                FROM pieces_w WHERE w <> '' GROUP BY ALL),
      rate AS (SELECT sum(n_stop)::DOUBLE / sum(n_stop + n_other)::DOUBLE AS even FROM types),
      measured AS (SELECT *, n_stop::DOUBLE AS own, n_other::DOUBLE AS rest, length(word) - length(replace(word, '.', '')) AS inner_stops FROM types),
      rated AS (SELECT *, CASE WHEN n_stop > 0 AND regexp_matches(word, '\\p{{L}}') THEN
                -2 * ((own * ln(even) + rest * ln(greatest(1 - even, 1e-12))) - (own * ln(0.99::DOUBLE) + rest * ln((1 - 0.99)::DOUBLE)))
                * exp(-(length(word) - inner_stops)::DOUBLE) * (inner_stops + 1) * pow((length(word) - inner_stops)::DOUBLE, -rest)
                ELSE 0 END AS score FROM measured, rate)"""
SENTENCE_END = f"[.!?][{WHITESPACE}]+|[{WHITESPACE}]*[\r\n][{WHITESPACE}]*"
LEARNED_SENTENCES = f"""WITH {WORD_TYPES},
      ends AS (SELECT word, score >= 0.3 AS abbreviation, n_small > 0 AND n_large = 0 AS starts FROM rated),
      cut AS (SELECT doc_id, regexp_split_to_array({stripped('text')}, '{SENTENCE_END}') AS l,
              regexp_extract_all({stripped('text')}, '{SENTENCE_END}') AS d FROM documents),
      breaks AS (SELECT doc_id, unnest(d) AS mark, generate_subscripts(d, 1) AS i, unnest(l[1:len(d)]) AS p, unnest(l[2:]) AS follows FROM cut),
      asked AS (SELECT *, mark[1] = '.' AND NOT regexp_matches(mark, '[\r\n]') AS stop,
                lower(regexp_extract(regexp_extract(p, '[^{WHITESPACE}]+$'), '{WORD}', 1)) AS w, regexp_extract(follows, '{WORD}', 1) AS f FROM breaks),
      told AS (SELECT a.*, coalesce(x.abbreviation, FALSE) OR regexp_matches(w, '^\\p{{L}}$') AS short,
               coalesce(y.starts, FALSE) AND regexp_matches(f, '^\\p{{Lu}}') AS opens,
               regexp_matches(w, '^\\p{{N}}+$') AND regexp_matches(f, '^\\p{{Ll}}') AS number
               FROM asked a LEFT JOIN ends x ON x.word = w LEFT JOIN ends y ON y.word = lower(f)),
      lines AS (SELECT doc_id, string_agg(p || CASE WHEN stop AND ((short AND NOT opens) OR number) THEN mark
                ELSE regexp_extract(mark, '^[.!?]') || chr(10) END, '' ORDER BY i) AS head FROM told GROUP BY doc_id)
      SELECT cut.doc_id, coalesce(head, '') || l[len(l)] AS text FROM cut LEFT JOIN lines ON lines.doc_id = cut.doc_id"""


def rouge_n(n: int) -> str:
    return f"WITH {PAIR_TOKENS}, {gram_scores(n, 'scored')}"


def word_stats(source: str) -> str:
    return f"""
      stats AS (SELECT token, count(*) AS count FROM (SELECT unnest({TOKENS.format("text")}) AS token FROM {source})
                GROUP BY token)"""


def summaries(source: str, key: str, order: str, name: str) -> str:
    """CTEs up to `name`(k, summary), after `stats`."""
    pieces = f"list_transform(string_split({LINES.format('text')}, chr(10)), lambda x: {stripped('x')})"
    return f"""
      {name}_l AS (SELECT {key} AS k, {order} AS o, list_filter({pieces}, lambda x: length(x) > 0) AS l FROM {source}),
      {name}_s AS (SELECT k, o, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM {name}_l),
      {name}_t AS (SELECT k, o, i, unnest({TOKENS.format("s")}) AS token FROM {name}_s),
      {name}_w AS (SELECT k, o, i, coalesce(sum(count), 0)::BIGINT / count(*) AS score
                   FROM {name}_t LEFT JOIN stats USING (token) GROUP BY ALL),
      {name}_r AS (SELECT k, o, i, s, coalesce(score, 0) AS score, len(string_split(s, ' ')) AS cost
                   FROM {name}_s LEFT JOIN {name}_w USING (k, o, i)),
      {name}_b AS (SELECT *, coalesce(sum(cost) OVER (PARTITION BY k ORDER BY score DESC, o, i
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM {name}_r),
      {name} AS (SELECT k, string_agg(array_to_string(string_split(s, ' ')[1:128 - before], ' '), ' ' ORDER BY o, i)
                 AS summary FROM {name}_b WHERE before < 50 GROUP BY k)"""


def parts(source: str, limit: int) -> str:
    """CTEs up to `parted`(source, part, n, reviews)."""
    return f"""
      sized AS (SELECT source, count(*) AS n, sum(length(text) + 1) AS chars FROM {source} GROUP BY source),
      places AS (SELECT source, doc_id, text, coalesce(sum(length(text) + 1) OVER (PARTITION BY source ORDER BY doc_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS chars_before FROM {source}),
      parted AS (SELECT source, CASE WHEN chars > {limit} AND n > 1 THEN (chars_before // {limit})::INTEGER ELSE 0 END AS part,
                 n, string_agg(text, ' ' ORDER BY doc_id) AS reviews
                 FROM places JOIN sized USING (source) WHERE n >= 10 GROUP BY ALL)"""


def summarized_groups(limit: int) -> str:
    return f"""WITH {CLEAN_DOCUMENTS}, {word_stats("docs")}, {summaries("docs", "source", "doc_id", "best")},
      {parts("docs", limit)}
      SELECT source, part, n, reviews, summary FROM parted JOIN best ON k = source"""


def longest(col: str) -> str:
    """Number of words and the longest one, the last by code point among equals."""
    words = f"list_filter(string_split('summarize: ' || {col}, ' '), lambda x: x <> '')"
    return f"len({words}) || ' ' || (list_max(list_transform({words}, lambda x: {{'n': length(x), 'w': x}}))).w"


PLAIN = "regexp_replace(text, '[\\t\\r\\n]+', ' ', 'g')"
TALK = f"SELECT conv_id * 1000 + turn AS id, prediction AS text, reference AS summary FROM ({ANSWERS})"
ENCODED = f"""WITH {vocab("documents", 2000)}, {ids("SELECT * FROM documents", "doc_id", "text", 1024, "e")}"""
def talk_ids(target: int) -> str:
    return f"""talk AS ({TALK}), {vocab("talk", 32_000)}, {ids("SELECT * FROM talk", "id", "text", 1024, "e")},
        {ids("SELECT * FROM talk", "id", "summary", target, "l")}"""


def batched(columns: str, within: str, multiple: int) -> str:
    """The last steps of padded batches: rows of `both_ids` numbered by id, each batch as long as its longest."""
    longest = "(max(len({0})) OVER w + {1}) // {2} * {2}".format
    return f"""
        numbered AS (SELECT *, ((row_number() OVER ({within}ORDER BY id) - 1) // 8)::BIGINT AS batch FROM both_ids),
        sized AS (SELECT *, {longest("a", multiple - 1, multiple)} AS la, {longest("b", multiple - 1, multiple)} AS lb
                  FROM numbered WINDOW w AS (PARTITION BY {columns}batch))
        SELECT id, {columns}batch, {joined(padded("a", "la", 0))} AS input_ids, {joined(padded("b", "lb", -100))} AS labels FROM sized"""


def exported(target: int, multiple: int) -> str:
    return f"""WITH talk AS (SELECT id, {SPLIT.format("id")} AS split, 'summarize: ' || text AS text, summary FROM ({TALK})
            WHERE length(text) > 0 AND length(summary) > 0),
        train_texts AS (SELECT text FROM talk WHERE split = 'train' UNION ALL SELECT summary FROM talk WHERE split = 'train'),
        {vocab("train_texts", 32_000)}, {ids("SELECT * FROM talk", "id", "text", 1024, "e")},
        {ids("SELECT * FROM talk WHERE split = 'train'", "id", "summary", 128, "l")},
        {ids("SELECT * FROM talk WHERE split <> 'train'", "id", "summary", target, "v")},
        both_ids AS (SELECT id, split, e.ids AS a, s.ids AS b FROM talk
                 JOIN e ON e.k = id JOIN (SELECT * FROM l UNION ALL SELECT * FROM v) s ON s.k = id),
        {batched("split, ", "PARTITION BY split ", multiple)}"""


BOTH_IDS = "both_ids AS (SELECT e.k AS id, e.ids AS a, l.ids AS b FROM e JOIN l ON l.k = e.k)"
MODEL_INPUT = f"""
      WITH words AS (SELECT source, doc_id, text, len(list_filter(string_split(text, ' '), lambda x: length(x) > 0)) AS cost
                     FROM documents),
      budget AS (SELECT *, coalesce(sum(cost) OVER (PARTITION BY source ORDER BY doc_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM words WHERE cost > 0),
      taken AS (SELECT source, string_agg(text, ' ' ORDER BY doc_id) AS reviews FROM budget WHERE before < 512
                GROUP BY source),
      groups AS (SELECT source, count(*) AS n FROM documents GROUP BY source HAVING count(*) >= 10)"""
METRICS = f"""{rouge_n(1)}
      SELECT CASE WHEN turn > 1 THEN 'later' ELSE 'first' END AS split, round(avg(precision) * 100, 4) AS precision,
      round(avg(recall) * 100, 4) AS recall, round(avg(f1) * 100, 4) AS f1, avg(turn) AS gen_len, count(*) AS samples
      FROM scored GROUP BY ALL"""

MARKED = "regexp_extract_all(lower({0}), '[a-z0-9]+|[.!?]')"
# Ids with sentence ends, decoded, a sentence a line, scored on stems: every step of an evaluation by its default settings.
EVALUATE = f"""WITH RECURSIVE pairs AS ({ANSWERS}),
      counted AS (SELECT token, count(*) AS count FROM (SELECT unnest({MARKED.format("text")}) AS token FROM conversations) GROUP BY token),
      vocab AS (SELECT token FROM counted QUALIFY row_number() OVER (ORDER BY count DESC, token) <= 32000),
      sides AS (SELECT conv_id, turn, 0 AS side, {MARKED.format("prediction")}[1:127] AS t FROM pairs
                UNION ALL SELECT conv_id, turn, 1, {MARKED.format("reference")}[1:127] FROM pairs),
      known AS (SELECT conv_id, turn, side, list(token ORDER BY i) AS t FROM
                (SELECT conv_id, turn, side, unnest(t) AS token, generate_subscripts(t, 1) AS i FROM sides) JOIN vocab USING (token) GROUP BY ALL),
      said AS (SELECT conv_id, turn, side, len(s.t) + 1 AS n, regexp_replace(array_to_string(coalesce(k.t, []), ' '), ' ([.!?])', '\\1', 'g') AS text
               FROM sides s LEFT JOIN known k USING (conv_id, turn, side)),
      lines AS (SELECT conv_id, turn, side, generate_subscripts(l, 1) AS k, unnest(l) AS line
                FROM (SELECT conv_id, turn, side, string_split({LINES.format("text")}, chr(10)) AS l FROM said)),
      words AS (SELECT conv_id, turn, side, k, generate_subscripts(t, 1) AS i, unnest(t) AS token FROM (SELECT *, {TOKENS.format("line")} AS t FROM lines)),
      {stems("SELECT token FROM words")},
      cut AS (SELECT conv_id, turn, side, k, list(stem ORDER BY i) AS t FROM words JOIN stemmed USING (token) GROUP BY ALL),
      ps AS (SELECT conv_id, turn, k AS pk, t AS p FROM cut WHERE side = 0),
      rs AS (SELECT conv_id, turn, k AS rk, t AS r FROM cut WHERE side = 1),
      whole AS (SELECT conv_id, turn, side, flatten(list(t ORDER BY k)) AS t FROM cut GROUP BY ALL),
      tokens AS (SELECT p.conv_id, p.turn, coalesce(x.t, []) AS a, coalesce(y.t, []) AS b, s.n FROM pairs p
                 JOIN said s ON s.conv_id = p.conv_id AND s.turn = p.turn AND s.side = 0
                 LEFT JOIN whole x ON x.conv_id = p.conv_id AND x.turn = p.turn AND x.side = 0
                 LEFT JOIN whole y ON y.conv_id = p.conv_id AND y.turn = p.turn AND y.side = 1),
      {gram_scores(1, "one")}, {gram_scores(2, "two")}, {LCS_SCORES.replace("steps", "lcs_steps")}, {UNION_LCS},
      summed AS (SELECT conv_id, turn, coalesce(h, 0) AS h, len(a)::DOUBLE AS p, len(b)::DOUBLE AS r FROM tokens LEFT JOIN hits USING (conv_id, turn)),
      lsum AS (SELECT conv_id, turn, {SHARES} FROM summed)
      SELECT CASE WHEN turn = 1 THEN 'first' ELSE 'later' END AS split, round(avg(one.f1) * 100, 4) AS rouge1,
      round(avg(two.f1) * 100, 4) AS rouge2, round(avg(lcs.f1) * 100, 4) AS "rougeL",
      round(avg(lsum.f1) * 100, 4) AS "rougeLsum", avg(n) AS gen_len, count(*) AS samples
      FROM tokens JOIN one USING (conv_id, turn) JOIN two USING (conv_id, turn) JOIN lcs USING (conv_id, turn) JOIN lsum USING (conv_id, turn)
      GROUP BY ALL"""

ORACLE: dict[str, str] = {
    "read_reviews": f"SELECT doc_id::VARCHAR AS doc_id, source, {PLAIN} AS text FROM documents",
    "read_damaged_reviews": """WITH fields AS (SELECT doc_id, CASE WHEN doc_id % 7 = 3 THEN '"' || source ELSE source END AS source,
            regexp_replace(text, '[\t\r\n"]+', ' ', 'g') AS text, doc_id % 11 = 5 AS short FROM documents)
        SELECT CASE WHEN NOT short THEN doc_id::VARCHAR END AS doc_id, CASE WHEN NOT short THEN source END AS source,
        CASE WHEN NOT short THEN nullif(text, '') END AS text,
        CASE WHEN short THEN 'quarantined' WHEN doc_id % 7 = 3 THEN 'mended' ELSE 'good' END AS state,
        CASE WHEN short THEN doc_id || chr(9) || source END AS raw FROM fields""",
    "read_json_fields": """SELECT 'train' AS split, doc_id::VARCHAR AS doc_id, text, CASE WHEN doc_id % 4 = 2 THEN (doc_id % 100)::VARCHAR END AS place,
        CASE WHEN doc_id % 4 <> 3 THEN source END AS summary FROM documents""",
    "read_pairs": f"""SELECT CASE WHEN {HASH.format("doc_id")} < 0.8 * 4294967296 THEN 'train' ELSE 'validation' END
        AS split, doc_id::VARCHAR AS doc_id, text, source AS summary FROM documents""",
    "save_cleaned": f"{CLEAN_PAGES} SELECT * FROM reviews",
    "write_pairs_csv": "SELECT text, source AS summary FROM documents",
    "write_predictions": f"""SELECT {stripped("regexp_replace(text, '[ \\t\\x0B\\f]*[\\r\\n][ \\t\\x0B\\f\\r\\n]*', ' ', 'g')")} AS value
        FROM documents""",
    "write_metrics": METRICS,
    "project_reviews": f"SELECT product_id, review_headline, review_body FROM ({PAGES})",
    "to_pairs": f"SELECT review_body AS text, review_headline AS summary FROM ({PAGES})",
    "keep_non_empty": """SELECT doc_id, source, regexp_extract(text, '[a-z]{10,}') AS long_word FROM documents
        WHERE length(source) > 0 AND regexp_extract(text, '[a-z]{10,}') <> ''""",
    "drop_incomplete_pairs": """SELECT conv_id, turn, text, role AS summary FROM conversations
        WHERE turn > 0 AND role <> 'system' AND length(text) > 0""",
    "resolve_columns": "SELECT doc_id, text, source AS summary FROM documents",
    "add_prefix": "SELECT doc_id, source, 'summarize: ' || text AS text FROM documents",
    "head_samples": "SELECT doc_id, source, text FROM documents ORDER BY doc_id LIMIT 100",
    "split_counts": f"""SELECT {SPLIT.format("doc_id")} AS split, least(500, count(*)) AS samples FROM documents
        GROUP BY ALL""",
    "strip_markup": f"SELECT page_id, {unmarked('html')} AS text FROM pages",
    "truncate_at_sentence": f"""WITH {cut("SELECT doc_id, text FROM documents", "doc_id", "text", 50, "t")}
        SELECT k AS doc_id, text FROM t""",
    "clean_text": f"""WITH {cleaned("SELECT doc_id, text FROM documents", "doc_id", "text", 100, "t")}
        SELECT k AS doc_id, text FROM t""",
    "clean_text_short": f"""WITH
        {cleaned("SELECT (conv_id, turn) AS id, text FROM conversations", "id", "text", 20, "t")}
        SELECT k[1] AS conv_id, k[2] AS turn, text FROM t""",
    "clean_reviews": f"{CLEAN_PAGES} SELECT * FROM reviews",
    "preview": "SELECT 10::BIGINT AS n, 10::BIGINT AS known, 10::BIGINT AS distinct_rows",
    "sample_rows": "SELECT count(*) AS n, TRUE AS repeats, TRUE AS about_a_tenth FROM documents",
    "random_split": "SELECT count(*) AS n, count(*) AS distinct_rows, TRUE AS about_four_fifths FROM documents",
    "hash_sample": f"SELECT doc_id, source FROM documents WHERE {HASH.format('doc_id')} < 0.1 * 4294967296",
    "hash_split": f"""SELECT doc_id, CASE WHEN {HASH.format("doc_id")} < 0.8 * 4294967296 THEN 'train'
        ELSE 'validation' END AS split FROM documents""",
    "collect_texts": """SELECT source, 0 AS part, count(*) AS n, string_agg(text, chr(31) ORDER BY doc_id) AS texts
        FROM documents GROUP BY source""",
    "count_rows": "SELECT source, count(*) AS n FROM documents GROUP BY source",
    "min_group_size": "SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id HAVING count(*) >= 4",
    "concat_texts": "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
    "review_by_group": f"WITH {parts('documents', 32 * 1024 * 1024)} SELECT source, part, n, reviews FROM parted",
    "review_by_group_in_parts": f"WITH {parts('documents', 20_000)} SELECT source, part, n, reviews FROM parted",
    "model_input_by_group": f"""{MODEL_INPUT}
        SELECT source, n, coalesce(reviews, '') AS reviews FROM groups LEFT JOIN taken USING (source)""",
    "mean_metrics": METRICS,
    "build_vocab": f"WITH {vocab('documents', 2000)} SELECT token, id, count FROM vocab",
    "encode": f"""WITH {vocab("documents", 2000)}, {ids("SELECT * FROM documents", "doc_id", "text", 1024, "e")}
        SELECT k AS doc_id, {joined("ids")} AS input_ids FROM e""",
    "encode_whole_vocabulary": f"""WITH {vocab("documents", 10_000_000)},
        {ids("SELECT * FROM documents", "doc_id", "text", 1024, "e")}
        SELECT k AS doc_id, {joined("ids")} AS input_ids FROM e""",
    "encode_pairs": f"""WITH {talk_ids(64)} SELECT e.k AS id, {joined("e.ids")} AS input_ids, {joined("l.ids")} AS labels
        FROM e JOIN l ON l.k = e.k""",
    "encode_pairs_at_defaults": f"""WITH {talk_ids(128)} SELECT e.k AS id, {joined(padded("e.ids", "1024", 0))} AS input_ids,
        {joined(padded("l.ids", "128", -100))} AS labels FROM e JOIN l ON l.k = e.k""",
    "pad_to_length": f"""{ENCODED} SELECT k AS doc_id, {joined(padded("ids", "1024", 0))} AS ids FROM e""",
    "mask_labels": f"""{ENCODED} SELECT k AS doc_id, {joined(padded("ids", "1024", -100))} AS ids FROM e""",
    "generated_length": f"{ENCODED} SELECT k AS doc_id, len(ids)::INTEGER AS n FROM e",
    "pad_batches": f"WITH {talk_ids(128)}, {BOTH_IDS}, {batched('', '', 8)}",
    "pad_batches_at_defaults": f"WITH {talk_ids(128)}, {BOTH_IDS}, {batched('', '', 1)}",
    "decode": f"""WITH {vocab("documents", 32_000)},
        t AS (SELECT doc_id, {TOKENS.format("text")}[1:1023] AS t FROM documents),
        u AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS i FROM t),
        g AS (SELECT doc_id, string_agg(token, ' ' ORDER BY i) AS text FROM u JOIN vocab USING (token) GROUP BY doc_id)
        SELECT t.doc_id, coalesce(g.text, '') AS text FROM t LEFT JOIN g ON g.doc_id = t.doc_id""",
    "decode_whole_texts": f"SELECT doc_id, array_to_string({TOKENS.format('text')}, ' ') AS text FROM documents",
    "subword_round_trip": "SELECT doc_id, TRUE AS ended, text FROM documents",
    "newline_sentences": f"SELECT doc_id, {LINES.format('text')} AS text FROM documents",
    "learned_abbreviations": f"""WITH {WORD_TYPES} SELECT word, n_stop, n_other, round(score, 6) + 0.0 AS score, score >= 0.3 AS abbreviation
        FROM rated WHERE n_stop > 0""",
    "learned_sentences": LEARNED_SENTENCES,
    "rouge_1": f"{rouge_n(1)} SELECT * FROM scored",
    "rouge_2": f"{rouge_n(2)} SELECT * FROM scored",
    "rouge_l": f"WITH RECURSIVE {PAIR_TOKENS}, {LCS_SCORES} SELECT * FROM lcs",
    "rouge_lsum": ROUGE_LSUM,
    "rouge_1_stemmed": f"""WITH pairs AS ({ANSWERS}),
        {stems(f"SELECT unnest({TOKENS.format('prediction')}) AS token FROM pairs UNION ALL SELECT unnest({TOKENS.format('reference')}) FROM pairs")},
        placed AS (SELECT conv_id, turn, 0 AS side, unnest(t) AS token, generate_subscripts(t, 1) AS i FROM (SELECT *, {TOKENS.format("prediction")} AS t FROM pairs)
                   UNION ALL SELECT conv_id, turn, 1, unnest(t), generate_subscripts(t, 1) FROM (SELECT *, {TOKENS.format("reference")} AS t FROM pairs)),
        listed AS (SELECT conv_id, turn, coalesce(list(stem ORDER BY i) FILTER (WHERE side = 0), []) AS a,
                   coalesce(list(stem ORDER BY i) FILTER (WHERE side = 1), []) AS b FROM placed JOIN stemmed USING (token) GROUP BY ALL),
        tokens AS (SELECT conv_id, turn, coalesce(a, []) AS a, coalesce(b, []) AS b FROM pairs LEFT JOIN listed USING (conv_id, turn)),
        {gram_scores(1, "scored")} SELECT * FROM scored""",
    "evaluate": EVALUATE,
    "fit_word_stats": f"""WITH {word_stats("documents")}
        SELECT token, count, count / (SELECT sum(count)::BIGINT FROM stats) AS p FROM stats""",
    "summarize": f"SELECT doc_id, {longest('text')} AS summary FROM documents",
    "padded_sizes": "SELECT count(*) AS texts, sum(length(text))::BIGINT AS chars, TRUE AS spared, TRUE AS holds_all FROM documents",
    "summarize_extractive": f"""WITH {word_stats("documents")}, {summaries("documents", "doc_id", "0", "best")}
        SELECT doc_id, coalesce(summary, '') AS summary FROM documents LEFT JOIN best ON k = doc_id""",
    "summarize_groups": summarized_groups(32 * 1024 * 1024),
    "summarize_groups_in_parts": summarized_groups(5_000),
    "summarize_groups_by_model": f"""{MODEL_INPUT}, {parts("documents", 32 * 1024 * 1024)}
        SELECT source, part, parted.n, parted.reviews, {longest("coalesce(taken.reviews, '')")} AS summary
        FROM parted LEFT JOIN taken USING (source)""",
    "predict": f"""WITH talk AS ({TALK}), split AS (SELECT id, text, {SPLIT.format("id")} AS split FROM talk),
        train AS (SELECT * FROM split WHERE split = 'train'), test AS (SELECT * FROM split WHERE split = 'test'),
        {word_stats("train")}, {summaries("test", "id", "0", "best")}
        SELECT {stripped("coalesce(summary, '')")} AS value FROM test LEFT JOIN best ON k = id""",
    "export_training_data": exported(64, 8),
    "export_training_data_at_defaults": exported(128, 1),
    "prepare_reviews": f"{RAW_PAGES} SELECT review_body AS text, review_headline AS summary FROM reviews",
    "prepare_reviews_by_key": f"""{RAW_PAGES}
        SELECT CASE WHEN {HASH.format("page_id").replace("42:", "43:")} < 0.8 * 4294967296 THEN 'train'
        ELSE 'validation' END AS split, review_body AS text, review_headline AS summary FROM reviews
        WHERE {HASH.format("page_id")} < 0.5 * 4294967296""",
    "summarize_stream": f"SELECT doc_id, {longest('text')} AS summary FROM documents",
    "summarize_stream_once": f"SELECT doc_id, {longest('text')} AS summary FROM documents",
    "map_batches": """SELECT doc_id, len(string_split(text, ' '))::BIGINT AS words FROM documents
        WHERE length(text) >= 500""",
}
ORACLE["summarize_stream_extractive"] = ORACLE["summarize_extractive"]
