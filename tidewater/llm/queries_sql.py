"""DuckDB SQL for the queries that SQL can express."""

from tidewater.llm import quality_rules as qr

QUALITY_RULES = rf"""
with lines as (
  select d.doc_id, u.pos, u.line, regexp_extract_all(u.line, '[^\x20\x09-\x0D]+') as w
  from (select doc_id, coalesce(text, '') as text from documents) d,
       unnest(string_split(d.text, chr(10))) with ordinality as u(line, pos)),
judged as (
  select doc_id, pos, w, line, len(w) as n, list_sum(list_transform(w, lambda x: length(x))) as chars,
    row_number() over (partition by doc_id, line order by pos) > 1 as again,
    length(regexp_replace(line, '[^{qr.SYMBOLS}]', '', 'g')) as symbols,
    length(regexp_replace(line, '[^!]', '', 'g')) as bangs,
    len(list_filter(w, lambda x: length(x) = 1 and contains('{qr.SEPARATORS}', x))) as seps,
    len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) as stutter,
    length(regexp_replace(line, '[^A-Z]', '', 'g')) as caps,
    length(regexp_replace(line, '[^A-Za-z]', '', 'g')) as letters,
    coalesce(list_sum(list_transform(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '{"|".join(qr.BOILERPLATE)}'), lambda x: length(replace(x, ' ', '')))), 0) as boiler
  from lines where len(w) > 0),
verdicts as (
  select *, again or 100 * symbols > {qr.SYMBOL_PERCENT} * chars or 100 * bangs > {qr.EXCLAIM_PERCENT} * chars
      or 100 * seps >= {qr.SEPARATOR_PERCENT} * n or 100 * stutter > {qr.STUTTER_PERCENT} * n
      or (letters >= 20 and 100 * caps > {qr.CAPITAL_PERCENT} * letters) or (boiler > 0 and 100 * boiler >= {qr.BOILER_PERCENT} * chars) as fails
  from judged),
per_doc as (
  select doc_id, sum(n) as n_words, sum(chars) as word_chars, count(*) filter (where again) as n_dup_lines,
    count(*) as n_lines, count(*) filter (where fails) as n_removed_lines,
    coalesce(sum(chars) filter (where fails), 0) as lost_chars, flatten(list(w order by pos)) as ws
  from verdicts group by doc_id),
grams as (
  select doc_id, i, ws[i:i + {qr.WINDOW - 1}] as g
  from (select doc_id, ws, unnest(range(1, len(ws) - {qr.WINDOW - 2})) as i from per_doc)),
twice as (select doc_id, i, count(*) over (partition by doc_id, g) as c from grams),
covered as (
  select doc_id, count(distinct p) as n
  from (select doc_id, unnest(range(i, i + {qr.WINDOW})) as p from twice where c > 1) group by doc_id),
measures as (
  select d.doc_id, coalesce(p.n_words, 0)::bigint as n_words, coalesce(p.word_chars, 0)::bigint as word_chars,
    length(regexp_replace(coalesce(d.text, ''), '[^{qr.SYMBOLS}]', '', 'g'))::bigint as n_symbols,
    coalesce(p.n_dup_lines, 0)::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
    coalesce(p.n_lines, 0)::bigint as n_lines, coalesce(p.n_removed_lines, 0)::bigint as n_removed_lines,
    coalesce(p.lost_chars, 0)::bigint as lost_chars
  from documents d left join per_doc p using (doc_id) left join covered c using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {qr.MIN_WORDS} or 100 * n_repeat_words > {qr.REPEAT_PERCENT} * n_words as base_failed,
  not (n_words < {qr.MIN_WORDS} or 100 * n_repeat_words > {qr.REPEAT_PERCENT} * n_words)
    and 100 * lost_chars <= {qr.LOST_PERCENT} * word_chars as kept,
  n_lines, n_removed_lines, lost_chars
from measures
"""


def _mixing() -> str:
    """Raking unrolled: one CTE per dimension and round, each round only if the one before has not met the targets,
    then the scale's steps."""
    from tidewater.llm import mixing as m

    def holds(name, marks, pattern):
        if pattern:
            return f"regexp_matches(t, '{pattern}')"
        return " or ".join(f"contains({'lower(t)' if name == 'licence' else 't'}, '{x}')" for x in marks)

    topic = " ".join(f"when {holds(*rule)} then '{rule[0]}'" for rule in m.TOPICS)
    ctes = [rf"""d as (
  select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang,
    case {topic} else '{m.OTHER_TOPIC}' end as topic, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as tokens
  from (select doc_id, source, lang, coalesce(text, '') as t from documents))""",
            "c0 as (select source, lang, topic, sum(tokens)::double as tokens, sum(tokens)::double as w from d group by all)"]
    for dim in m.DIMENSIONS:
        ctes.append(f"g_{dim} as (select {dim} as name, u / sum(u) over () as target from "
                    f"(select {dim}, pow(sum(tokens), {m.ALPHA[dim]}) as u from c0 group by 1))")
    k = 0
    ctes.append("o0 as (select true as goes, 'inf'::double as off)")
    for j in range(m.MAX_ROUNDS):
        first = k + 1
        for dim in m.DIMENSIONS:
            k += 1
            ctes.append(f"c{k} as materialized (select c.source, c.lang, c.topic, c.tokens, case when not o.goes then c.w "
                        f"when c.s > 0 then c.w * (g.target / c.s) else 0 end as w, abs(c.s - g.target) as e from (select *, "
                        f"sum(w) over (partition by {dim}) as s from c{k - 1}) c join g_{dim} g on g.name = c.{dim}, o{j} o)")
        seen = " union all ".join(f"select max(e) as e from c{i}" for i in range(first, k + 1))
        ctes.append(f"o{j + 1} as materialized (select any_value(o.goes) and max(e) > {m.TOLERANCE!r} and max(e) <= {m.STALLED} * "
                    f"any_value(o.off) as goes, max(e) as off from ({seen}), o{j} o)")
    ctes.append(f"r as materialized (select *, case when tokens > 0 then w * (select sum(tokens) from c0) / tokens else 1 end as weight from c{k})")
    ctes.append(f"s0 as materialized (select {m.FRACTION}::double as s)")
    for j in range(1, m.SCALE_STEPS + 1):
        ctes.append(f"""s{j} as materialized (select greatest(s, coalesce(({m.FRACTION} * (select sum(tokens) from c0)
  - (select coalesce(sum(tokens), 0) from r where weight * s >= 1))
  / nullif((select sum(tokens * weight) from r where weight * s < 1), 0), s)) as s from s{j - 1})""")
    return "with " + ",\n".join(ctes) + f"""
select doc_id, source, lang, topic, d.tokens::bigint as tokens, round(weight, 6) as weight,
  round(least(1.0, weight * s), 6) as probability,
  ('0x' || substr(md5(coalesce(doc_id::varchar, 'null')), 1, 8))::bigint / 4294967296.0 < round(least(1.0, weight * s), 6) as sampled
from d join r using (source, lang, topic), s{m.SCALE_STEPS}
"""


MIXING = _mixing()

# op13: digests of all fields, runs of eight per language and level, every leaf folded upwards run by run.
# crc32 of a decimal number: its bytes are taken in one after the other, eight shifts each.
MANIFEST = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    text, coalesce(xor(list_reduce(
      flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END,
      4294967295::BIGINT), 4294967295) % 3 = 0, false) AS changed
  FROM documents),
leaves AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS grp,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN changed THEN sha256(head || coalesce(strlen(text) || ':'
      || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS other
  FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY grp) AS n FROM leaves),
tree AS (
  SELECT grp, 0 AS lvl, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT grp, lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 7) // 8
  FROM tree WHERE n > 1 GROUP BY grp, lvl, pos // 8),
subroots AS (
  SELECT grp, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
crown AS (
  SELECT 0 AS lvl, pos, subroot AS h, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 7) // 8
  FROM crown WHERE n > 1 GROUP BY lvl, pos // 8),
runs AS (
  SELECT grp, lvl, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM tree WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT NULL, lvl, pos // 8, list(h ORDER BY pos) FROM crown WHERE n > 1 GROUP BY ALL),
low AS (
  SELECT doc_id, grp, leaf, pos AS place, 0 AS lvl, pos, coalesce(other, leaf) AS h, '' AS proof FROM placed
  UNION ALL
  SELECT doc_id, grp, leaf, place, low.lvl + 1, pos // 8,
    sha256(array_to_string(hs[1:pos % 8], '') || h || array_to_string(hs[pos % 8 + 2:], '')),
    proof || array_to_string(hs[1:pos % 8], '') || array_to_string(hs[pos % 8 + 2:], '')
  FROM low JOIN runs USING (grp, lvl) WHERE run = pos // 8),
high AS (
  SELECT doc_id, grp, leaf, place, subroot, 0 AS lvl, s.pos, h, proof
  FROM (SELECT * FROM low QUALIFY lvl = max(lvl) OVER (PARTITION BY grp, place)) JOIN subroots s USING (grp)
  UNION ALL
  SELECT doc_id, high.grp, leaf, place, subroot, high.lvl + 1, pos // 8,
    sha256(array_to_string(hs[1:pos % 8], '') || h || array_to_string(hs[pos % 8 + 2:], '')),
    proof || array_to_string(hs[1:pos % 8], '') || array_to_string(hs[pos % 8 + 2:], '')
  FROM high JOIN runs ON runs.grp IS NULL AND runs.lvl = high.lvl AND run = pos // 8)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM (SELECT * FROM high QUALIFY lvl = max(lvl) OVER (PARTITION BY grp, place)),
  (SELECT h AS root FROM crown WHERE n = 1)
"""

# op12: all phrases of one to three words listed and counted, cuts looked up, longer candidates compared.
COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM places),
one AS (SELECT lang, x, count(*) AS f FROM grams GROUP BY ALL),
two AS (SELECT lang, x, y, count(*) AS f FROM grams WHERE y IS NOT NULL GROUP BY ALL),
three AS (SELECT lang, x, y, z, count(*) AS f FROM grams WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT lang, x || ' ' || y AS phrase, t.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM two t JOIN one l USING (lang, x) JOIN (SELECT lang, x AS y, f FROM one) r USING (lang, y)
  WHERE t.f >= 10 AND NOT EXISTS (SELECT 1 FROM three e WHERE e.lang = t.lang AND 100 * e.f >= 50 * t.f
    AND ((e.x = t.x AND e.y = t.y) OR (e.y = t.x AND e.z = t.y)))
  UNION ALL
  SELECT t.lang, concat_ws(' ', t.x, t.y, t.z), t.f, 1, l.f, r.f FROM three t
  JOIN one l ON l.lang = t.lang AND l.x = t.x JOIN two r ON r.lang = t.lang AND r.x = t.y AND r.y = t.z
  UNION ALL
  SELECT t.lang, concat_ws(' ', t.x, t.y, t.z), t.f, 2, l.f, r.f FROM three t
  JOIN two l ON l.lang = t.lang AND l.x = t.x AND l.y = t.y JOIN one r ON r.lang = t.lang AND r.x = t.z),
scored AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang) USING (lang) WHERE rank <= 2000
"""
