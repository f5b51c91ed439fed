"""DuckDB SQL of the registered queries, built from shared common table expressions.

RE2 has no look-around: designations are cut at doubled blanks, and the one letter that word boundaries of RE2 do not know
(U+00DF) is spelled out while abbreviations are expanded. Levenshtein counts bytes there, so other letters than ASCII are
first replaced by capitals and signs, which normalised texts lack. The Indel similarities count a longest common
subsequence with the bits of a 128-bit integer (names and the shorter of two addresses have less characters).
"""

from __future__ import annotations

import re

from .functions import text as X
from .operators import blocking as B
from .operators.labels import RULE_BONUS

JOIN = "chr(1)"

# Names that stand in for some documents' own, as Indic texts and in Latin letters, and designations.
INDIC_NAMES = ("सूर्य वस्त्र भंडार", "నీలం పుస్తకాలు", "கல்வி மையம்", "ગુજરાત વેપાર", "বাংলা ভাণ্ডার")
LATIN_NAMES = ("soorya vastra bhandaara", "neelan pustakaalu", "kalvi maiyam", "gujaraata vepaara", "baanlaa bhaandaara")
INDIC_SUFFIX = "प्राइवेट लिमिटेड"
SUFFIXES = ("Pvt Ltd", "GmbH", "LLC", "SARL", "Private Limited", "Inc")


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def accents(x: str) -> str:
    one, plain, more = X.accent_map()
    out = f"translate({x}, {quoted(one)}, {quoted(plain)})"
    for a, b in more:
        out = f"replace({out}, {quoted(a)}, {quoted(b)})"
    return out


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


LEGAL = "|".join(re.escape(s).replace("\\ ", "  ").replace(" ", " ") for s in sorted(X.LEGAL, key=len, reverse=True))
PREFIX = X.PREFIX.removeprefix("(?i)")
GRAMS = "list_distinct(list_transform(range(1, length({x}) - {n} + 2), lambda i: substring({x}, i, {n})))"


def address_sql() -> str:
    out = "regexp_replace(a0, '\\b(?:null|undefined|none)\\b|[#*]+', ' ', 'g')"
    for short, full in X.ABBREVIATIONS:
        out = f"regexp_replace({out}, '\\b(?:{short})\\b\\.?', '{full}', 'g')"
    return out


def name_sql(x: str) -> str:
    """A normalised name."""
    bare = f"regexp_replace(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '{PREFIX}', '', 'i')"
    return squeeze(f"regexp_replace(regexp_replace(replace(lower({accents(bare)}), '&', ' and '), '[''’`]', '', 'g'), '[^\\p{{L}}\\p{{N}}\\p{{M}}\\s]', ' ', 'g')")


def legal_sql(norm: str) -> str:
    """A normalised name without designations."""
    cut = squeeze(f"regexp_replace(regexp_replace(' ' || replace({norm}, ' ', '  ') || ' ', ' (?:{LEGAL}) ', ' ', 'g'), '(^|[^\\p{{L}}\\p{{N}}_])(?:and|et)\\s*$', '\\1')")
    return f"coalesce(nullif({cut}, ''), {norm})"


def latin_sql(x: str) -> str:
    """Indic scripts in Latin letters, a character at a time: a consonant has an `a` unless a sign follows."""
    place, following = "(unicode(c) % 128)", f"coalesce(unicode(nullif(substring({x}, i + 1, 1), '')), 0)"
    sound = " ".join(f"when {k} then {quoted(v)}" for k, v in X.INDIC.items())
    signs = ", ".join(str(k) for k in X.INDIC if 0x3E <= k <= 0x4D)
    vowel = f"case when ({place} between 21 and 57 or {place} between 88 and 95) and not ({following} between 2304 and 3455 and {following} % 128 in ({signs})) then 'a' else '' end"
    return f"array_to_string(list_transform(string_split({x}, ''), lambda c, i: case when unicode(c) between 2304 and 3455 then case {place} {sound} else '' end || {vowel} else c end), '')"


def pick(names: tuple[str, ...], n: int) -> str:
    return f"([{', '.join(map(quoted, names))}])[doc_id % {n} + 1]"


def ev() -> str:
    target = "(doc_id % 3 <> 0)"
    script = f"({target} = (doc_id % 8 < 4))"
    return f"""ev as (
  select concat(case doc_id % 3 when 0 then 'S1-' when 1 then 'S2-' else 'S3-' end, doc_id) as entity_id,
    case when doc_id % 23 <> 5 then case when doc_id % 7 = 2 then array_to_string(w[1:4], '') else case when doc_id % 17 = 8 then 'M/s. ' else '' end || array_to_string(w[1:4], ' ') end
      when {script} then {pick(INDIC_NAMES, 5)} when not {target} and doc_id % 4 = 1 then replace({pick(LATIN_NAMES, 5)}, ' ', '') else {pick(LATIN_NAMES, 5)} end
    || case when not {target} or doc_id % 4 <> 1 then '' when doc_id % 23 = 5 and {script} then ' {INDIC_SUFFIX}' else ' ' || {pick(SUFFIXES, 6)} end as business_name,
    case when doc_id % 31 = 4 then 'none' else case when doc_id % 19 = 6 then concat('Plot No. ', doc_id % 50, '-B Main St. ') else '' end
      || concat(n_chars, ' ', array_to_string(w[5:9], ' '), ' ', lpad((n_chars % 900 + 10000)::varchar, 5, '0')) end as business_address, lang as country,
    md5(lower(text)) as digest
  from (select *, string_split_regex(trim(text), '\\s+') as w from documents))"""


def prep(ev: str) -> str:
    return f"""{ev},
p1 as (select *, substring(entity_id, 1, 2) as source, {name_sql("business_name")} as norm, regexp_matches(business_name, '[\\x{{0900}}-\\x{{0D7F}}]') as has_indic,
    regexp_matches(business_address, '[\\x{{0900}}-\\x{{0D7F}}]') as address_indic, {latin_sql("business_name")} as latin, replace(lower({accents("trim(business_address)")}), 'ß', 'qxzq') as a0
  from ev),
p2 as (select *, case when has_indic then {name_sql("latin")} else norm end as trans,
    {squeeze(f"regexp_replace(replace({address_sql()}, 'qxzq', 'ß'), '[^\\p{{L}}\\p{{N}}\\p{{M}}\\s\\-/]', ' ', 'g')")} as address,
    regexp_extract_all(business_address, '\\b([1-9][0-9]{{5}})\\b', 1) as six, regexp_extract_all(business_address, '\\b([0-9]{{5}})\\b', 1) as five,
    regexp_replace(regexp_extract(trim(business_address), '{X.HOUSE_PREFIXED.removeprefix("(?i)")}', 1, 'i'), '^[#\\-/\\s]+|[#\\-/\\s]+$', '', 'g') as h1, regexp_extract(trim(business_address), '{X.HOUSE_LEADING}', 1) as h2
  from p1),
prep as (select entity_id, source, country, digest, business_name, business_address, has_indic, address_indic, norm, trans, case when has_indic then trans else norm end as eff,
    regexp_replace(lower(norm), '[^\\p{{L}}\\p{{N}}\\p{{M}}]', '', 'g') as compact, {legal_sql("norm")} as nosuff, {legal_sql("trans")} as trans_nosuff, address,
    coalesce(six[-1], five[-1], '') as postal,
    case when h1 similar to '.*[0-9].*' then h1 when h2 <> '' then regexp_replace(h2, '[#\\-/\\s]+$', '', 'g') else '' end as house,
    case when norm = '' then [] else string_split(norm, ' ') end as toks, case when trans = '' then [] else string_split(trans, ' ') end as toks_trans, case when address = '' then [] else string_split(address, ' ') end as atoks
  from p2),
s1 as (select * from prep where source = 'S1'), tgt as (select * from prep where source <> 'S1'),
truth as (select s1.entity_id as s1_id, tgt.entity_id as cand_id from s1 join tgt on s1.digest = tgt.digest and s1.country = tgt.country)"""


EV = ev()
PREP = prep(EV)

STOP = ", ".join(quoted(w) for w in X.ADDRESS_STOPWORDS)
def consonants_sql(x: str) -> str:
    return f"regexp_replace(lower({x}), '[^\\p{{L}}]|[aeiou]', '', 'g')"


def compact_sql(x: str) -> str:
    return f"regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}\\p{{M}}]', '', 'g')"


def skeleton_sql(nosuff: str) -> str:
    return f"case when length({consonants_sql(nosuff)}) >= 4 then substring(rpad({consonants_sql(nosuff)}, 5, ' '), 1, 5) end"


FIT = "length(t) >= 4 and not regexp_full_match(t, '[0-9]+') and t not in (" + STOP + ")"

EFF_NOSUFF = "case when has_indic then trans_nosuff else nosuff end"
FIRST = "case when length({x}) >= {n} then substring({x}, 1, {n}) end"
# rule, evidence, key of the target, key of the probe, cap; a null or empty key is none
SIMPLE = [
    ("exact_norm", "blocked_exact_name", "case when length(norm) >= 3 then norm end", "norm", B.BUCKET),
    ("exact_compact", "blocked_compact_name", "case when length(compact) >= 3 then compact end", "compact", B.BUCKET),
    ("nosuff", "blocked_suffix_name", "case when length(nosuff) >= 3 then nosuff end", "nosuff", B.BUCKET),
    ("nosuff_compact", "blocked_suffix_name", "case when length(nosuff) >= 3 and sc <> compact then sc end", "sc", B.BUCKET),
    ("translit", "blocked_translit", "case when has_indic then trans end", "norm", B.BUCKET),
    ("translit_nosuff", "blocked_translit", "case when has_indic then trans_nosuff end", "nosuff", B.BUCKET),
    ("translit_compact", "blocked_translit", f"unnest(case when has_indic then [{compact_sql('trans')}, {compact_sql('trans_nosuff')}] end)", "sc", B.BUCKET),
    ("postal_prefix", "blocked_postal", f"case when postal <> '' and length(eff) >= 3 then postal || {JOIN} || substring(eff, 1, 3) end", f"case when postal <> '' and length(norm) >= 3 then postal || {JOIN} || substring(norm, 1, 3) end", B.BUCKET),
    ("postal_token", "blocked_postal", f"case when postal <> '' and length(string_split(eff, ' ')[1]) >= 3 then postal || {JOIN} || string_split(eff, ' ')[1] end", f"case when postal <> '' and length(toks[1]) >= 3 then postal || {JOIN} || toks[1] end", B.BUCKET),
    ("postal_house", "blocked_house", f"case when postal <> '' and house <> '' then postal || {JOIN} || lower(house) end", f"case when postal <> '' and house <> '' then postal || {JOIN} || lower(house) end", B.BUCKET),
    ("house_prefix", "blocked_house", f"case when length(house) >= 2 and length(eff) >= 3 then lower(house) || {JOIN} || substring(eff, 1, 3) end", f"case when house <> '' and length(norm) >= 3 then lower(house) || {JOIN} || substring(norm, 1, 3) end", B.BUCKET),
    ("house", "blocked_house", "case when length(house) >= 2 then lower(house) end", "lower(house)", B.HOUSE_BUCKET),
    ("consonant_skel", "blocked_consonant_skeleton", skeleton_sql(f"({EFF_NOSUFF})"), skeleton_sql("nosuff"), B.SKELETON_BUCKET),
]


def postings_sql(side: str, table: str) -> str:
    name = "eff" if side == "target" else "norm"
    rows = [f"select country, '{r}' as rule, '{e}' as evidence, {t if side == 'target' else p} as key, entity_id as id from (select *, {compact_sql('nosuff')} as sc from {table})" for r, e, t, p, _ in SIMPLE]
    rows.append(f"select country, 'addr_token', 'blocked_address_token', token, entity_id from {table}_tokens where n80 <= 3 and df <= {B.TOKEN_FREQUENCY}")
    rows.append(f"select t.country, 'addr_name', 'blocked_address_name_combo', case when length({name}) >= 2 then token || {JOIN} || substring({name}, 1, 2) end, t.entity_id from {table}_tokens t join {table} using (entity_id) where n100 <= 3")
    return "select * from (" + " union all ".join(rows) + ") where key <> ''"


def tokens_sql(table: str) -> str:
    return f"""{table}_tokens as (
  select *, sum(case when df <= {B.TOKEN_FREQUENCY} then 1 else 0 end) over (partition by entity_id order by pos rows unbounded preceding) as n80,
    row_number() over (partition by entity_id order by pos) as n100
  from (select p.country, entity_id, pos, t as token, coalesce(df, 0) as df
    from (select country, entity_id, unnest(atoks) as t, generate_subscripts(atoks, 1) as pos from {table}) p left join df on p.country = df.country and p.t = df.token
    where {FIT}) where df <= {B.COMBO_FREQUENCY})"""


CAPS = " ".join(f"when '{r}' then {c}" for r, _, _, _, c in SIMPLE) + f" when 'addr_token' then {B.TOKEN_FREQUENCY} when 'addr_name' then {B.COMBO_BUCKET}"
BLOCK = f"""{PREP},
df as (select country, t as token, count(*) as df from (select distinct country, entity_id, unnest(atoks) as t from tgt) where {FIT} group by all),
{tokens_sql("s1")}, {tokens_sql("tgt")},
tk as ({postings_sql("target", "tgt")}),
pk as (select distinct country, rule, key, id as s1_id from ({postings_sql("probe", "s1")})),
fit as (select country, rule, key from tk group by all having count(*) <= case rule {CAPS} end),
pairs as (select distinct s1_id, id as cand_id, rule, evidence from pk join tk using (country, rule, key) join fit using (country, rule, key)),
basic as (select distinct s1_id, cand_id, evidence from pairs where rule not in ('consonant_skel', 'addr_name')),
ev_pairs as (select s1_id, cand_id, string_agg(distinct evidence, ',' order by evidence) as rules, count(distinct evidence) as num_blocking_rules from basic group by all)"""

_WORD_GRAMS = "unnest(case when length(w) + 2 >= k then list_transform(range(1, length(w) + 4 - k), lambda i: substring(' ' || w || ' ', i, k)) else [' ' || w || ' '] end) as gram from {} cross join (values (3), (4), (5)) v(k)"
NGRAM = f"""gt as (select entity_id as id, country, unnest(case when eff = '' then [] else string_split(eff, ' ') end) as w from tgt), gs as (select entity_id as id, country, unnest(toks) as w from s1),
grams as (select 't' as side, * from (select id, country, {_WORD_GRAMS.format('gt')}) union all select 's', * from (select id, country, {_WORD_GRAMS.format('gs')})),
tf as (select side, id, country, gram, count(*) as tf from grams group by all), n as (select country, count(*) as n from tgt group by all),
idf as (select country, gram, ln((1 + n) / (1 + df)) + 1 as idf from (select country, gram, count(*) as df from tf where side = 't' group by all) join n using (country) where n < 10 or (df >= 2 and df <= 0.25 * n)),
w as (select side, id, country, gram, tf * idf as w from tf join idf using (country, gram)),
u as (select w.side, w.id, country, gram, w / norm as w from w join (select side, id, sqrt(sum(w * w)) as norm from w group by all) m on w.side = m.side and w.id = m.id),
sims as (select a.id as s1_id, b.id as cand_id, round(sum(a.w * b.w), 6) as sim from u a join u b on a.country = b.country and a.gram = b.gram where a.side = 's' and b.side = 't' group by all),
near as (select s1_id, cand_id, sim from (select *, row_number() over (partition by s1_id order by sim desc, cand_id) as r from sims) where r <= 10 and sim >= 0.4)"""

#: Pairs of the default rules with both records, and the score of the pipeline that needs no training.
PAIRS = f"""{BLOCK},
xy as (select e.*, x.norm as n1, y.norm as n2, x.compact as c1, y.compact as c2, x.nosuff as s1n, y.nosuff as s2n, x.toks as t1, y.toks as t2, x.address as a1, y.address as a2,
    case when y.has_indic then y.trans else y.norm end as n2e, x.atoks as d1, y.atoks as d2, lower(x.postal) as p1, lower(y.postal) as p2, lower(x.house) as h1, lower(y.house) as h2, x.country as country
  from ev_pairs e join prep x on e.s1_id = x.entity_id join prep y on e.cand_id = y.entity_id),
scored as (select *, round(0.7 * jac::float::double + 0.3 * greatest(case when p1 <> '' and p1 = p2 then 1 else 0 end, case when h1 <> '' and h1 = h2 then 1 else 0 end), 6) as prob,
    case when (s1_id, cand_id) in (select (s1_id, cand_id) from truth) then 1 else 0 end as label
  from (select *, case when len(list_distinct(list_concat(t1, t2))) = 0 then 1.0::double else len(list_intersect(list_distinct(t1), list_distinct(t2)))::double / len(list_distinct(list_concat(t1, t2))) end as jac from xy))"""


def hardness() -> str:
    has = lambda names: " or ".join(f"list_contains(string_split(rules, ','), '{n}')" for n in names)
    bonus = " + ".join(f"case when {has(n)} then {b} else 0 end" for n, b in RULE_BONUS)
    return f"""(2.0 * num_blocking_rules + {bonus} + case when n1 = '' or n2e = '' then 0 when n1 = n2e then 5 when length(n1) >= 3 and length(n2e) >= 3 and substring(n1, 1, 3) = substring(n2e, 1, 3) then 2 else 0 end
      + case when p1 <> '' and p1 = p2 then 3 else 0 end + case when h1 <> '' and h1 = h2 then 2 else 0 end)::double"""


SAMPLED = f"""h as (select s1_id, cand_id, label, {hardness()} as hardness from scored),
per as (select s1_id, sum(label) as p, sum(1 - label) as n from h group by all),
b as (select *, floor(budget * 0.8) as hard from (select s1_id, case when p > 0 then least(n, greatest(2, least(25, floor(p * 4)))) else least(n, 3) end as budget from per)),
r as (select h.*, b.budget, b.hard, row_number() over (partition by h.s1_id order by hardness desc, cand_id) as r from h join b using (s1_id) where label = 0),
q as (select *, row_number() over (partition by s1_id, r <= hard order by md5('42|' || s1_id || '|' || cand_id)) as q from r),
sampled as (select s1_id, cand_id, label, hardness from h where label = 1 union all select s1_id, cand_id, label, hardness from q where r <= hard or q <= budget - hard)"""

F05 = "case when true_n = 0 and predicted = 0 then 1.0 when true_n = 0 or predicted = 0 or tp = 0 then 0.0 else 1.25 * (tp / predicted) * (tp / true_n) / (0.25 * tp / predicted + tp / true_n) end"


def entities(thresholds: list[float]) -> str:
    grid = ", ".join(f"({t}::double)" for t in thresholds)
    return f"""{PAIRS},
grid(threshold) as (values {grid}),
counted as (select s1_id, threshold, count(*) as predicted, sum(label) as tp from scored join grid on prob >= threshold group by all),
trues as (select s1_id, count(*) as n from (select distinct * from truth) group by all),
entity as (select *, {F05} as f05 from (select g.threshold, s.entity_id as s1_id, s.country, coalesce(c.predicted, 0) as predicted, coalesce(t.n, 0) as true_n, coalesce(c.tp, 0) as tp
  from s1 s cross join grid g left join counted c on c.s1_id = s.entity_id and c.threshold = g.threshold left join trues t on t.s1_id = s.entity_id))"""


def sweep_sql(by: str = "") -> str:
    return f"""select threshold, {by} avg(f05) as macro_f05, p as "precision", r as recall, case when p + r > 0 then 2 * p * r / (p + r) else 0 end as f1,
  case when one > 0 then one_right / one else 0 end as singleton_accuracy, mean_predicted, entities_with_fp
from (select *, case when sp > 0 then st / sp else 0 end as p, case when sn > 0 then st / sn else 0 end as r from (
  select threshold, {by} avg(f05) as f05, sum(tp) as st, sum(predicted) as sp, sum(true_n) as sn, avg(predicted) as mean_predicted, sum((true_n = 0)::int)::double as one,
    sum((true_n = 0 and predicted = 0)::int) as one_right, sum((predicted > tp)::int)::bigint as entities_with_fp from entity group by all)) group by all"""


# The 96 features. Names: x is the S1 record, y the target.

#: Letters beyond ASCII that normalised texts of the tables hold, with stand-ins.
ODD = "".join(sorted({c for n in (*INDIC_NAMES, INDIC_SUFFIX) for c in n.lower() if c != " "} | set("ßøæœđłþðı")))
STANDS = "".join(map(chr, (*range(65, 91), *range(33, 39), *range(40, 45), *range(58, 65), *range(91, 97), *range(123, 127), *range(1, 9), *range(14, 32))))[: len(ODD)]
assert len(STANDS) == len(ODD)


def grams_sql(x: str, n: int) -> str:
    return f"case when length({x}) >= {n} then {GRAMS.format(x=x, n=n)} when {x} <> '' then [{x}] else [] end"


def lev_sql(a: str, b: str) -> str:
    plain = lambda x: f"translate({x}, {quoted(ODD)}, {quoted(STANDS)})"
    return f"case when {a} = '' and {b} = '' then 1.0::double when {a} = '' or {b} = '' then 0.0::double else 1 - levenshtein({plain(a)}, {plain(b)})::double / greatest(length({a}), length({b})) end"


def jaccard_sql(a: str, b: str) -> str:
    return f"case when len(list_distinct(list_concat({a}, {b}))) = 0 then 1.0::double else len(list_intersect(list_distinct({a}), list_distinct({b})))::double / len(list_distinct(list_concat({a}, {b}))) end"


def indel_sql(a: str, b: str) -> str:
    """Twice the longest common subsequence over both lengths. a has at most 120 characters."""
    full = f"((1::hugeint << length({a})::int) - 1)"
    bits = f"list_reduce(list_prepend(0::hugeint, list_transform(range(1, length({a}) + 1), lambda at_: case when substring({a}, at_, 1) = char_ then 1::hugeint << (at_ - 1)::int else 0::hugeint end)), lambda p_, q_: p_ | q_)"
    row = f"list_reduce(list_prepend({full}, list_transform(string_split({b}, ''), lambda char_: {bits})), lambda row_, hit_: ((row_ + (row_ & hit_)) | (row_ - (row_ & hit_))) & {full})"
    return f"(case when {a} = '' and {b} = '' then 1.0::double when {a} = '' or {b} = '' then 0.0::double else 2.0::double * (length({a}) - bit_count({row})) / (length({a}) + length({b})) end)"


def sorted_sql(x: str) -> str:
    return f"array_to_string(list_sort({x}), ' ')"


def partial_sql(a: str, b: str) -> str:
    """Of texts with length(a) <= length(b)."""
    windows = f"list_transform(range(1 - length({a}), length({b})), lambda k_: substring({b}, greatest(k_, 0) + 1, k_ + length({a}) - greatest(k_, 0)))"
    return f"(case when {a} = '' or {b} = '' then ({a} = {b})::int::double when contains({b}, {a}) then 1.0::double else list_max(list_transform({windows}, lambda window_: {indel_sql(a, 'window_')})) end)"


def indels(key: str, a: str, b: str, source: str) -> str:
    """Common table expressions <key>0.. <key>: of the distinct texts a, b of `source`: indel, tsort, tset, weighted."""
    both, one, two = "list_intersect(x, y)", "list_filter(x, lambda v_: not list_contains(y, v_))", "list_filter(y, lambda v_: not list_contains(x, v_))"
    order = lambda p, q, side: f"case when length({p}) <= length({q}) then {p if side == 0 else q} else {q if side == 0 else p} end"
    swap = lambda p, q, name: f"{order(p, q, 0)} as {name}1, {order(p, q, 1)} as {name}2"
    return f"""{key}0 as (select distinct {a} as a, {b} as b from {source}),
{key}1 as (select *, case when a = '' then [] else list_distinct(string_split(a, ' ')) end as x, case when b = '' then [] else list_distinct(string_split(b, ' ')) end as y, {sorted_sql("string_split(a, ' ')")} as sa, {sorted_sql("string_split(b, ' ')")} as sb from {key}0),
{key}2 as (select *, {sorted_sql(both)} as c, {sorted_sql(one)} as o, {sorted_sql(two)} as t, greatest(length(a), length(b))::double / greatest(least(length(a), length(b)), 1) as long from {key}1),
{key}3 as (select *, trim(c || ' ' || o) as co, trim(c || ' ' || t) as ct, {swap('a', 'b', 'p')}, {swap('sa', 'sb', 's')}, {swap('o', 't', 'u')} from {key}2),
{key}4 as (select *, {indel_sql('p1', 'p2')} as indel, {indel_sql('s1', 's2')} as tsort,
    case when a = '' and b = '' then 1.0::double when a = '' or b = '' then 0.0::double when c <> '' and (o = '' or t = '') then 1.0::double
      else greatest({indel_sql("case when length(co) <= length(ct) then co else ct end", "case when length(co) <= length(ct) then ct else co end")}, case when c <> '' then greatest({indel_sql('c', 'co')}, {indel_sql('c', 'ct')}) else 0 end) end as tset from {key}3),
{key} as (select a, b, indel, tsort, tset, case when a = '' and b = '' then 1.0::double when a = '' or b = '' then 0.0::double when long < 1.5 then greatest(indel, 0.95::double * tsort, 0.95::double * tset)
    else greatest(indel, (case when long <= 8 then 0.9::double else 0.6::double end) * {partial_sql('p1', 'p2')}, 0.95::double * (case when long <= 8 then 0.9::double else 0.6::double end) * greatest({partial_sql('s1', 's2')}, case when c <> '' then 1.0::double else {partial_sql('u1', 'u2')} end)) end as weighted from {key}4)"""


def feature_sql() -> dict[str, str]:
    """Each feature over the columns of `both96`."""
    flag = lambda c: f"coalesce({c}, false)::int::double"
    same = lambda a, b: flag(f"({a} <> '' and {a} = {b})")
    ratio = lambda a, b: f"case when greatest({a}, {b}) > 0 then least({a}, {b})::double / greatest({a}, {b}) else 1.0::double end"
    common = lambda a, b: f"len(list_intersect(list_distinct({a}), list_distinct({b})))::double"
    size = lambda a: f"len(list_distinct({a}))"
    part = lambda n, d: f"case when {d} > 0 then {n} / {d} else 0.0::double end"
    prefix = lambda a, b, n: flag(f"(length({a}) >= {n} and length({b}) >= {n} and substring({a}, 1, {n}) = substring({b}, 1, {n}))")
    diff = lambda a, b: f"abs({a} - {b})::double"
    there = lambda v: f"case when m1 or m2 then 0.0::double else {v} end"
    out = {
        "name_exact": same("x.norm", "y.norm"), "name_compact_exact": same("x.compact", "y.compact"), "name_nosuff_exact": same("x.nosuff", "y.nosuff"), "name_translit_exact": same("x.norm", "y.trans"), "name_nosuff_translit_exact": same("x.nosuff", "y.trans_nosuff"),
        "name_levenshtein_ratio": "i1.indel", "name_normalized_levenshtein": lev_sql("x.norm", "y.norm"), "name_token_sort_ratio": "i1.tsort", "name_token_set_ratio": "i1.tset", "name_w_ratio": "i1.weighted",
        "name_translit_levenshtein_ratio": "i2.indel", "name_translit_normalized_levenshtein": lev_sql("x.norm", "y.trans"), "name_translit_token_sort_ratio": "i2.tsort", "name_translit_token_set_ratio": "i2.tset", "name_translit_w_ratio": "i2.weighted",
        **{f"name_char{n}_jaccard": jaccard_sql(f"x.g{n}", f"y.g{n}") for n in (2, 3, 4, 5)}, **{f"name_translit_char{n}_jaccard": jaccard_sql(f"x.g{n}", f"y.h{n}") for n in (2, 3, 4)},
        "name_token_jaccard": jaccard_sql("x.toks", "y.toks"), "name_token_overlap_count": common("x.toks", "y.toks"),
        "name_shared_token_fraction_min": part(common("x.toks", "y.toks"), f"least({size('x.toks')}, {size('y.toks')})"), "name_shared_token_fraction_max": part(common("x.toks", "y.toks"), f"greatest({size('x.toks')}, {size('y.toks')})"),
        "name_translit_token_jaccard": jaccard_sql("x.toks", "y.toks_trans"), "name_translit_token_overlap_count": common("x.toks", "y.toks_trans"), "name_translit_shared_token_fraction_min": part(common("x.toks", "y.toks_trans"), f"least({size('x.toks')}, {size('y.toks_trans')})"),
        "name_length_diff": diff("length(x.norm)", "length(y.norm)"), "name_length_ratio": ratio("length(x.norm)", "length(y.norm)"), "name_token_count_diff": diff("len(x.toks)", "len(y.toks)"), "name_token_count_ratio": ratio("len(x.toks)", "len(y.toks)"),
        "name_first_token_exact": flag("x.toks[1] = y.toks[1]"), "name_last_token_exact": flag("x.toks[-1] = y.toks[-1]"), **{f"name_prefix{n}_exact": prefix("x.norm", "y.norm", n) for n in (3, 4, 5)},
        "name_translit_first_token_exact": flag("x.toks[1] = y.toks_trans[1]"), "name_translit_prefix3_exact": prefix("x.norm", "y.trans", 3),
        "consonant_skeleton_exact": same("x.skel", "skel2"), "consonant_skeleton_levenshtein": lev_sql("x.skel", "skel2"), "consonant_skeleton_jaccard": jaccard_sql(grams_sql("x.skel", 2), grams_sql("skel2", 2)),
        "consonant_skeleton_len_diff": diff("length(x.skel)", "length(skel2)"), "consonant_skeleton_len_ratio": ratio("length(x.skel)", "length(skel2)"),
        "address_exact": there(flag("x.address = y.address")), "address_compact_similarity": there(lev_sql("x.caddr", "y.caddr")), "address_levenshtein_ratio": there("i3.indel"), "address_normalized_levenshtein": there(lev_sql("x.address", "y.address")),
        "address_token_jaccard": there(jaccard_sql("x.atoks", "y.atoks")), "address_token_set_ratio": there("i3.tset"), "address_char3_ngram_jaccard": there(jaccard_sql("x.a3", "y.a3")), "address_length_ratio": there(ratio("length(x.address)", "length(y.address)")),
        "address_token_count_ratio": there(ratio("len(x.atoks)", "len(y.atoks)")), "address_numeric_token_overlap": there(common("x.nums", "y.nums")), "address_numeric_token_jaccard": there(jaccard_sql("x.nums", "y.nums")),
        "house_number_exact": same("x.lhouse", "y.lhouse"), "postal_code_exact": same("x.postal", "y.postal"), "postal_code_prefix3_exact": prefix("x.postal", "y.postal", 3),
        "s1_address_missing": flag("m1"), "candidate_address_missing": flag("m2"), "both_address_missing": flag("(m1 and m2)"), "either_address_missing": flag("(m1 or m2)"),
        "postal_missing_either": flag("(x.postal = '' or y.postal = '')"), "postal_missing_both": flag("(x.postal = '' and y.postal = '')"), "house_missing_either": flag("(x.house = '' or y.house = '')"), "house_missing_both": flag("(x.house = '' and y.house = '')"),
        "same_country": same("x.country", "y.country"), "s1_has_indic": flag("ix"), "candidate_is_indic": flag("iy"), "is_cross_script": flag("ix <> iy"), "name_has_transliteration": flag("y.trans <> y.norm"), "s1_script_latin": flag("not ix"), "candidate_script_latin": flag("not iy"),
        "candidate_source_is_S2": flag("starts_with(cand_id, 'S2-')"), "candidate_source_is_S3": flag("starts_with(cand_id, 'S3-')"), **{r: flag(f"list_contains(string_split(rules, ','), '{r}')") for r in B.RULES}, "num_blocking_rules": "num_blocking_rules::double",
    }
    return out


def derived_sql() -> dict[str, str]:
    """Features over the others, as doubles."""
    flag = lambda c: f"({c})::int::double"
    return {
        "same_postal_and_high_name_sim": flag("postal_code_exact = 1 and name_normalized_levenshtein >= 0.7::double"), "same_house_and_high_name_sim": flag("house_number_exact = 1 and name_normalized_levenshtein >= 0.7::double"),
        "same_postal_and_same_house": flag("postal_code_exact = 1 and house_number_exact = 1"), "same_postal_and_same_name_prefix": flag("postal_code_exact = 1 and name_prefix3_exact = 1"), "addr_sim_x_name_sim": "address_token_jaccard * name_normalized_levenshtein",
        "max_name_similarity": "most_name", "max_address_similarity": "most_address", "name_and_addr_high_confidence": flag("most_name >= 0.8::double and most_address >= 0.6::double"),
        "name_exact_diff_address": flag("(name_exact = 1 or name_translit_exact = 1) and either_address_missing = 0 and address_token_jaccard < 0.2::double"),
    }


_GRAM_COLUMNS = ", ".join([f"{grams_sql('norm', n)} as g{n}" for n in (2, 3, 4, 5)] + [f"{grams_sql('trans', n)} as h{n}" for n in (2, 3, 4)] + [f"{grams_sql('address', 3)} as a3"])
RECORDS = f"""rec as (select *, {consonants_sql("nosuff")} as skel, {consonants_sql("trans_nosuff")} as trans_skel, {compact_sql("address")} as caddr, lower(house) as lhouse,
    list_distinct(list_filter(regexp_extract_all(lower(address), '[\\p{{L}}\\p{{N}}_]+'), lambda t: regexp_full_match(t, '\\p{{Nd}}+[a-z]?|[a-z]?\\p{{Nd}}+'))) as nums, {_GRAM_COLUMNS} from prep)"""
_MOST_NAME = "greatest(name_normalized_levenshtein, name_translit_normalized_levenshtein, name_token_sort_ratio, name_token_set_ratio, name_w_ratio, consonant_skeleton_levenshtein)"
_MOST_ADDRESS = "greatest(address_normalized_levenshtein, address_token_jaccard, address_token_set_ratio, address_char3_ngram_jaccard)"
_MISSING = "in ('', 'none', 'null', 'undefined')"


def features_sql(names: list[str]) -> str:
    """... feat: s1_id, cand_id, label, prob and all features, rounded to floats. names: in order."""
    plain, derived = feature_sql(), derived_sql()
    floats = ", ".join(f"({derived.get(n, n)})::float::double as {n}" for n in names)
    return f"""{PAIRS}, {RECORDS},
sides as (select e.*, x, y, x.address {_MISSING} as m1, y.address {_MISSING} as m2, x.has_indic or x.address_indic as ix, y.has_indic or y.address_indic as iy,
    case when y.has_indic or y.address_indic then y.trans_skel else y.skel end as skel2, case when length(x.address) <= length(y.address) then x.address else y.address end as short_address, case when length(x.address) <= length(y.address) then y.address else x.address end as long_address
  from (select s1_id, cand_id, rules, num_blocking_rules, label, prob from scored) e join rec x on e.s1_id = x.entity_id join rec y on e.cand_id = y.entity_id),
{indels("i1", "x.norm", "y.norm", "sides")}, {indels("i2", "x.norm", "y.trans", "sides")}, {indels("i3", "short_address", "long_address", "sides")},
plain96 as (select s1_id, cand_id, label, prob, {", ".join(f"{v} as {k}" for k, v in plain.items())} from sides join i1 on i1.a = x.norm and i1.b = y.norm join i2 on i2.a = x.norm and i2.b = y.trans join i3 on i3.a = short_address and i3.b = long_address),
most as (select *, {_MOST_NAME} as most_name, {_MOST_ADDRESS} as most_address from plain96),
feat as (select s1_id, cand_id, label, prob, {floats} from most)"""


def errors_sql(threshold: float) -> str:
    """Classes of wrong pairs of `feat`, in the order in which they apply."""
    name, address = "name_levenshtein_ratio", "address_levenshtein_ratio"
    fp = [
        ("missing_address", "either_address_missing = 1"), ("commercial_homonym_franchise", f"name_exact_diff_address = 1 or (name_exact = 1 and {address} < 0.35::double)"), ("same_house_diff_biz", f"house_number_exact = 1 and {name} < 0.7::double"),
        ("same_postal_diff_biz", f"postal_code_exact = 1 and {name} < 0.7::double"), ("cross_script_false_match", "is_cross_script = 1"), ("generic_company_name", f"name_token_jaccard >= 0.75::double and {name} < 0.85::double"), ("similar_name_wrong_address", f"{name} >= 0.85::double and {address} < 0.5::double"),
    ]
    fn = [
        ("missing_address", "either_address_missing = 1"), ("cross_script_translit_divergence", "is_cross_script = 1 and name_translit_levenshtein_ratio < 0.8::double"), ("low_address_similarity", f"{address} < 0.4::double and {name} >= 0.8::double"), ("low_name_similarity_dba", f"{name} < 0.65::double"),
        ("legal_suffix_variation", f"name_nosuff_exact = 1 and ({address} < 0.65::double or house_missing_either = 1)"), ("missing_house_number", f"house_missing_either = 1 and {address} < 0.6::double"), ("missing_postal_code", f"postal_missing_either = 1 and {address} < 0.6::double"), ("typo_ocr_variation", f"{name} >= 0.65::double and {name} < 0.82::double"),
    ]
    chain = lambda cases, other: "case " + " ".join(f"when {t} then '{n}'" for n, t in cases) + f" else '{other}' end"
    return f"""select kind, category, count(*) as n from (select 'fp' as kind, {chain(fp, 'other_marginal_false_merges')} as category from feat where label = 0 and prob >= {threshold}
  union all select 'fn', {chain(fn, 'other_marginal_confidence_drop')} from feat where label = 1 and prob < {threshold}) group by all"""


HARD_POSITIVE = {
    "hp_missing_address": "candidate_address_missing = 1", "hp_divergent_address": "candidate_address_missing = 0 and address_token_jaccard < 0.35::double", "hp_low_name": "name_normalized_levenshtein < 0.65::double or name_token_sort_ratio < 0.65::double",
    "hp_cross_script": "is_cross_script = 1", "hp_translit": "name_has_transliteration = 1 and name_translit_normalized_levenshtein < 0.75::double", "hp_missing_codes": "postal_missing_either = 1 and house_missing_either = 1 and name_normalized_levenshtein < 0.85::double",
}
HARD_NEGATIVE = {
    "hn_homonym": "name_exact_diff_address = 1", "hn_missing_address": "name_normalized_levenshtein >= 0.85::double and candidate_address_missing = 1", "hn_same_postal": "same_postal_and_high_name_sim = 1", "hn_same_house": "same_house_and_high_name_sim = 1",
    "hn_cross_script": "is_cross_script = 1 and name_translit_normalized_levenshtein >= 0.8::double", "hn_many_rules": "num_blocking_rules >= 3 and address_token_jaccard < 0.3::double", "hn_same_tokens": "name_token_sort_ratio >= 0.85::double and address_token_jaccard < 0.2::double and candidate_address_missing = 0",
}


def hard_sql() -> str:
    one = {k: f"label = 1 and ({v})" for k, v in HARD_POSITIVE.items()} | {k: f"label = 0 and ({v})" for k, v in HARD_NEGATIVE.items()}
    both = {"hard_positive": " or ".join(f"({v})" for v in HARD_POSITIVE.values()), "hard_negative": " or ".join(f"({v})" for v in HARD_NEGATIVE.values())}
    columns = one | {"hard_positive": f"label = 1 and ({both['hard_positive']})", "hard_negative": f"label = 0 and ({both['hard_negative']})"}
    return "select " + ", ".join(f"sum(({v})::int)::bigint as {k}" for k, v in columns.items()) + " from feat"


def miss_sql() -> str:
    """Why links (table `links`) were missed by the pairs of the exact rules; s: the S1 record, t: the target."""
    name = lev_sql("s.norm", "n2")
    same = "case when s.has_indic <> t.has_indic then t.trans else t.norm end"
    cases = [
        ("missing_address", f"t.address {_MISSING.replace("'', ", '')} or t.address = ''"), ("missing_postal", "s.postal = '' and t.postal = '' and name < 0.6"), ("transliteration", "s.has_indic <> t.has_indic and name < 0.4"), ("indic_script", "s.has_indic <> t.has_indic"),
        ("legal_suffix", "s.nosuff = bare2 and s.nosuff <> ''"), ("word_order", "list_sort(list_distinct(s.toks)) = list_sort(list_distinct(toks2)) and len(list_distinct(s.toks)) >= 2"),
        ("typo", f"levenshtein(translate(s.nosuff, {quoted(ODD)}, {quoted(STANDS)}), translate(bare2, {quoted(ODD)}, {quoted(STANDS)})) <= 2 and least(length(s.nosuff), length(bare2)) >= 4"),
        ("frequent_bucket", "s.house <> '' and lower(s.house) = lower(t.house) and regexp_full_match(s.house, '[0-9]{1,9}') and try_cast(s.house as integer) <= 25"), ("missing_house", "s.house = '' and t.house = '' and name < 0.7"),
        ("address_variation", f"s.address <> '' and {jaccard_sql('s.atoks', 't.atoks')} < 0.15"), ("name_variation", "name < 0.5"),
    ]
    chain = "case " + " ".join(f"when {t} then '{n}'" for n, t in cases) + " else 'other' end"
    return f"""joined as (select s, t, {same} as n2, case when s.has_indic <> t.has_indic then t.trans_nosuff else t.nosuff end as bare2, case when s.has_indic <> t.has_indic then t.toks_trans else t.toks end as toks2
    from links join s1 s on s.entity_id = s1_id join tgt t on t.entity_id = cand_id where (s1_id, cand_id) not in (select (s1_id, cand_id) from pairs where rule in ('exact_norm', 'exact_compact', 'nosuff', 'nosuff_compact'))),
named as (select *, {name} as name from joined)
select {chain} as category, count(*) as n from named group by all"""


def online_sql(mode: str) -> str:
    """... cands: s1_id, cand_id, evidence, source, ordinal of the online or preflight blocker."""
    pair = lambda a, b: f"case when {a} <> '' and {b} <> '' then {a} || {JOIN} || {b} end"
    three = "case when length(norm) >= 3 then substring(norm, 1, 3) else '' end"
    fit = "list_filter(atoks, lambda v_: length(v_) >= 4 and not regexp_full_match(v_, '\\p{Nd}+') and v_ not in (" + STOP + "))"
    combo = f"unnest(list_transform(list_filter(atoks, lambda v_: length(v_) >= 4)[1:3], lambda v_: case when length(norm) >= 2 then v_ || {JOIN} || substring(norm, 1, 2) end))"
    cons = consonants_sql("nosuff")
    grams = f"unnest(case when length(sc) < 4 then [] when length(sc) = 4 then [sc] else {grams_sql('sc', 5)} end)"
    both = [
        ("exact", "blocked_exact_name", "norm", None), ("compact", "blocked_compact_name", "compact", None), ("nosuff", "blocked_suffix_name", "nosuff", None), ("translit", "blocked_translit", "norm", "case when has_indic then trans end"), ("postal_prefix", "blocked_postal", pair("postal", three), None),
        ("postal_house", "blocked_house", pair("postal", "lower(house)"), None), ("house_prefix", "blocked_house", pair("lower(house)", three), None), ("consonant_skel", "blocked_consonant_skeleton", f"case when length({cons}) >= 4 then substring({cons}, 1, 5) end", None), ("addr_name", "blocked_address_name_combo", combo, None),
    ]
    if mode == "preflight":
        both += [("postal_token", "blocked_postal", f"case when postal <> '' and length(toks[1]) >= 3 then postal || {JOIN} || toks[1] end", None), ("translit_nosuff", "blocked_translit", "case when has_indic then trans_nosuff end", None)]
    else:
        both += [("addr_token", "blocked_address_token", f"unnest(({fit})[1:3])", f"unnest({fit})"), ("char_ngram", "blocked_char_ngram", grams, None)]
    side = lambda k, t: "select * from (" + " union all ".join(f"select country, '{r}' as rule, '{e}' as evidence, {(x if k == 0 or y is None else y)} as key, entity_id as id from (select *, {compact_sql('nosuff')} as sc from {t})" for r, e, x, y in both) + ") where key <> ''"
    caps = " ".join(f"when '{r}' then {n}" for r, n in B.ONLINE_CAPS.items())
    rare = f"where not (rule = 'addr_token' and n > {B.TOKEN_RARITY}) and not (rule = 'char_ngram' and n > {B.GRAM_RARITY})" if mode == "online" else ""
    return f"""{PREP}, o as (select entity_id as id, source, row_number() over (partition by source, country order by entity_id) as ordinal from tgt),
op as (select * from (select *, count(*) over (partition by country, rule, key) as n from (select distinct country, rule, key, id as s1_id from ({side(1, "s1")}))) {rare}),
ot as (select * from (select p.*, o.source, o.ordinal, row_number() over (partition by country, rule, key order by o.source, o.ordinal, id) as r from ({side(0, "tgt")}) p join o using (id)) where r <= case rule {caps} else 1000000000 end),
cands as (select distinct s1_id, ot.id as cand_id, evidence, source, ordinal from op join ot using (country, rule, key)),
grouped as (select s1_id, cand_id, source, min(ordinal) as ordinal, string_agg(distinct evidence, ',' order by evidence) as rules from cands group by all)"""


ENRICHED = f"""select entity_id, skel, trans_skel, caddr as compact_address, array_to_string(toks, ' ') as toks, array_to_string(toks_trans, ' ') as toks_trans, array_to_string(atoks, ' ') as toks_address, array_to_string(list_sort(nums), ' ') as nums, array_to_string(list_sort(a3), '|') as char3_address,
  {", ".join([f"array_to_string(list_sort(g{n}), '|') as char{n}_name" for n in (2, 3, 4, 5)] + [f"array_to_string(list_sort(h{n}), '|') as char{n}_trans" for n in (2, 3, 4)])} from rec"""
