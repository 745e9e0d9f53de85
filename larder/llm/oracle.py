"""DuckDB SQL for the queries that SQL can express, over the same whole tables."""

from __future__ import annotations

from larder.llm import mixing, quality_rules, spelling

WORD = r"[^\x20\x09-\x0D]+"


def quality_sql() -> str:
    """The counts in SQL; expectation-maximisation as one pair of steps per iteration over the counted vote patterns."""
    rules = quality_rules.RULES
    names = [f"v{j}" for j in range(len(rules))]
    votes = []
    for name, rule in zip(names, rules, strict=True):
        good = "" if rule.good is None else f" when {rule.measure} <= {rule.good} then 1"
        votes.append(f"case when n_words = 0 then 0 when {rule.measure} > {rule.bad} then -1{good} else 0 end as {name}")
    odds = " + ".join(f"{v} * ln(a{j} / (1 - a{j}))" for j, v in enumerate(names))
    q = f"1 / (1 + exp(-(ln(g / (1 - g)) + {odds})))"
    low, high = quality_rules.ACCURACY
    prior = f"({quality_rules.PRIOR_SHARE} * sum(n))"
    accuracies = ", ".join(
        f"least(greatest((sum(n * case when {v} > 0 then q when {v} < 0 then 1 - q else 0 end) + {quality_rules.START} * {prior})"
        f" / (sum(n * abs({v})) + {prior}), {low}), {high}) as a{j}"
        for j, v in enumerate(names)
    )
    least, most = quality_rules.GOOD_SHARE
    steps = [f"m0 as (select 0.5::double as g, {', '.join(f'{quality_rules.START}::double as a{j}' for j in range(len(rules)))})"]
    for i in range(quality_rules.ITERATIONS):
        steps.append(f"e{i} as materialized (select {', '.join(names)}, n, {q} as q from patterns, m{i})")
        steps.append(f"m{i + 1} as materialized (select least(greatest(sum(n * q) / sum(n), {least}), {most}) as g, {accuracies} from e{i})")
    return f"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
split as (select doc_id, text, regexp_extract_all(text, '{WORD}') as ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines from texts),
places as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as w
  from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from split)),
twice as (select doc_id, i from places qualify count(*) over (partition by doc_id, w) > 1),
covered as (select doc_id, count(distinct i + k) as n from twice, (values (0), (1), (2)) as t(k) group by doc_id),
counts as (select doc_id, len(ws)::bigint as n_words,
  coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
  coalesce(c.n, 0)::bigint as n_repeat_words, len(lines) as n_lines,
  len(regexp_extract_all(text, '[#*$%&|<>{{}}\\[\\]\\\\^~=_]+|[!?]{{2,}}')) as n_noise,
  len(regexp_extract_all(text, '\\p{{Lu}}')) as n_capitals, len(regexp_extract_all(text, '!')) as n_exclamations
  from split left join covered c using (doc_id)),
voted as (select *, {", ".join(votes)} from counts),
patterns as materialized (select {", ".join(names)}, count(*)::double as n from voted group by all),
{", ".join(steps)},
judged as (select *, {q} as quality, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed
  from voted, m{quality_rules.ITERATIONS})
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and quality >= {quality_rules.THRESHOLD} as kept, round(quality, 4) as quality from judged
"""


SUBSTRING = f"""
with split as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as ws from documents),
starts as (select doc_id, i, array_to_string(ws[i : i + 19], ' ') as w
  from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from split)),
again as (select doc_id, i from starts qualify row_number() over (partition by w order by doc_id, i) > 1),
gone as (select distinct doc_id, i + k as i from again, range(20) as t(k)),
positions as (select doc_id, i, ws[i] as word from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from split)),
kept as (select p.doc_id, string_agg(p.word, ' ' order by p.i) as text, count(*) as n
  from positions p anti join gone g on p.doc_id = g.doc_id and p.i = g.i group by p.doc_id)
select s.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(k.n, 0))::bigint as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from split s left join kept k using (doc_id)
"""

MIXING = f"""
with sized as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
  md5(concat_ws(':', '{mixing.SEED}', doc_id::varchar)) as h from documents),
placed as (select *, (((strpos('0123456789abcdef', substr(h, 1, 1)) - 1) * 16 + strpos('0123456789abcdef', substr(h, 2, 1)) - 1) * 16
  + strpos('0123456789abcdef', substr(h, 3, 1)) - 1) % {mixing.BUCKETS} as bucket from sized),
weighed as (select source, sum(size)::bigint as source_size, sum(size)::double * {mixing.MAX_EPOCHS} as cap,
  ({list(map(float, mixing.WEIGHTS))})[(row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)} + 1]::double as weight from sized group by source),
levels as (select *, ((sum(source_size) over ())::double - coalesce(sum(cap) over (w rows between unbounded preceding and 1 preceding), 0))
  / sum(weight) over (w rows between current row and unbounded following) as level
  from weighed window w as (order by cap / weight, source nulls last)),
flat as (select *, (select level from levels l where l.level * l.weight <= l.cap order by l.cap / l.weight, l.source nulls last limit 1) as flat from levels),
targets as (select source, source_size, least(cap, coalesce(flat * weight, cap)) as target,
  case when source_size > 0 then floor(least(cap, coalesce(flat * weight, cap)) / source_size) else 0 end as repeats from flat),
buckets as (select source, bucket, sum(size) as size, coalesce(sum(sum(size)) over (partition by source order by bucket
  rows between unbounded preceding and 1 preceding), 0) as before from placed group by source, bucket),
plan as (select b.source, b.bucket, t.source_size, t.target, t.repeats,
  case when b.size > 0 then least(greatest((t.target - t.repeats * t.source_size - b.before) / b.size, 0), 1) else 0 end as extra
  from buckets b join targets t on b.source is not distinct from t.source)
select p.doc_id, p.size, l.source_size, l.target, (l.repeats * p.size
  + least(floor(l.extra * p.size + 0.5), p.size * {mixing.MAX_EPOCHS} - l.repeats * p.size))::bigint as taken
from placed p join plan l on p.source is not distinct from l.source and p.bucket = l.bucket
"""

NEAR = f"""
with recursive split as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as ws from documents),
shingles as (select distinct doc_id, array_to_string(ws[i : i + 3], ' ') as s
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) as i from split where len(ws) > 0)),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as materialized (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * common.n >= 80 * (x.n + y.n - common.n)),
ends as materialized (select a, b from links union all select b, a from links),
reached(doc_id, other) as (select doc_id, doc_id from documents union select r.doc_id, e.b from reached r join ends e on r.other = e.a),
components as (select doc_id, min(other) as component_id from reached group by doc_id)
select c.doc_id, coalesce(s.n, 0)::bigint as n_shingles, c.component_id, c.doc_id = c.component_id as kept
from components c left join sizes s using (doc_id)
"""

#: The checksum of a string as a fold over its UTF-8 bytes; ``t`` is its table of 256 steps, made by the rule of its polynomial.
CRC_TABLE = """select list_transform(range(256), lambda i: list_reduce([i] || range(8),
  lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t"""


def crc32(value: str) -> str:
    code = "unicode(ch)::bigint"
    two = f"[192 + ({code} >> 6), 128 + ({code} & 63)]"
    octets = f"flatten(list_transform(string_split({value}, ''), lambda ch: case when {code} < 128 then [{code}] else {two} end))"
    return f"xor(list_reduce([4294967295] || {octets}, lambda c, o: xor(c >> 8, t[(xor(c, o) & 255) + 1])), 4294967295)"


SPELLING = f"""
with recursive steps as ({CRC_TABLE}),
found as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents),
runs as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from found group by all),
hashed as (select run, n, {crc32("concat(doc_id, ':', run)")} as h from runs, steps),
written as (select case when h % {spelling.EVERY} = 0 then concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) else run end as word, n from hashed),
words as materialized (select word, sum(n)::bigint as n from written group by word
  having sum(n) >= {spelling.MIN_COUNT} and length(word) >= {spelling.MIN_LENGTH}),
rests as materialized (select word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
replaced as (select a.word, b.word as other, b.n as other_n from rests a join rests b on a.i = b.i and a.rest = b.rest and a.word <> b.word),
shorter as (select a.word as word, a.n as n, b.word as other, b.n as other_n from rests a join words b on a.rest = b.word),
near as materialized (select * from replaced union select word, other, other_n from shorter union select other, word, n from shorter),
best as materialized (select word, count(*) over (partition by word) as n_near, other, other_n from near
  qualify row_number() over (partition by word order by other_n desc, other) = 1),
named as materialized (select w.word, n, coalesce(n_near, 0)::bigint as n_near, case when other_n >= {spelling.RATIO} * n then other end as form,
  case when other_n >= {spelling.RATIO} * n then other_n end as form_n from words w left join best b on w.word = b.word),
ways as (select word, form as place, 1 as step from named where form is not null
  union all select w.word, n.form, step + 1 from ways w join named n on w.place = n.word where n.form is not null),
ends as (select word, arg_max(place, step) as root from ways group by word)
select n.word, form, coalesce(root, n.word) as root, n, n_near, form_n from named n left join ends e on n.word = e.word
"""

ORACLE = {
    "op1_quality_rules": quality_sql(),
    "op3_substring_dedup": SUBSTRING,
    "op6_mixing": MIXING,
    "op9_near_dedup": NEAR,
    "op12_spelling": SPELLING,
}
