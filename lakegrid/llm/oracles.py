"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from .op6_quality import CLASSES, DIGITS, LOWER, MARKS, MAX_CLASS_DISTANCE, MAX_COMMON_DISTANCE, MIN_WORDS_CLASSES, MIN_WORDS_COMMON, SYMBOLS, UPPER, WORDS

def _linked(width: int, percent: int, kept: str = "") -> str:
    return f"""with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) >= {width} then list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i+{width - 1}], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from w),
n as (select w.doc_id, count(s.g) as n from w left join s using (doc_id) group by w.doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= {percent} * (x.n + y.n - k)),
r(doc_id, reached) as (select doc_id, doc_id from n union select r.doc_id, l.b from r join l on l.a = r.reached)
select n.doc_id, any_value(n.n) as n_shingles, min(r.reached) as component_id{kept} from n join r using (doc_id) group by n.doc_id"""


OP4 = _linked(5, 75)
OP11 = _linked(2, 80, ", n.doc_id = min(r.reached) as kept")


def _n(letters: str) -> str:
    return f"length(t) - length(translate(t, '{letters}', ''))"


def _apart(h: str, ref: str) -> str:
    term = "case when {0} > 0 then {0} * log2({0} / (({0} + {1}) / 2)) else 0.0::double end"
    return f"sqrt(greatest(0, list_sum(list_transform(list_zip({h}, {ref}), lambda z: {term.format('z[1]', 'z[2]')} + {term.format('z[2]', 'z[1]')})) / 2))"


OP6 = f"""with d as (select doc_id, lang, coalesce(text, '') as t from documents),
f0 as (select *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from d),
f1 as (select doc_id, lang, w, len(w) as n_words, len(l) - len(list_distinct(l)) as n_dup_lines, length(t) - length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) as space, length(t) as n_chars, {_n(SYMBOLS)} as symbol, {_n(DIGITS)} as digit, {_n(UPPER)} as upper, {_n(LOWER)} as lower, length(regexp_replace(t, '[\\x00-\\x7F]', '', 'g')) as beyond, list_filter(string_split_regex(translate(t, '{UPPER}{MARKS}', '{LOWER}{' ' * len(MARKS)}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w2 from f0),
g0 as (select doc_id, unnest(range(1, n_words - 3)) as i, w from f1 where n_words >= 5), g as (select doc_id, i, array_to_string(w[i:i+4], ' ') as g from g0),
rep as (select doc_id, i from g qualify count(*) over (partition by doc_id, g) > 1), cov as (select doc_id, count(distinct k) as n from (select doc_id, unnest([i, i + 1, i + 2, i + 3, i + 4]) as k from rep) group by doc_id),
f as (select f1.*, coalesce(cov.n, 0) as n_repeat_words, [{", ".join(c if c != "rest" else "n_chars - space - symbol - digit - upper - lower - beyond" for c in CLASSES)}]::double[] as h1,
  list_concat([{", ".join(f"len(list_filter(w2, lambda x: x = '{x}'))" for x in WORDS)}], [len(list_filter(w2, lambda x: x not in ({", ".join(f"'{x}'" for x in WORDS)})))])::double[] as h2 from f1 left join cov using (doc_id)),
rf as (select lang, [{", ".join(f"sum(h1[{k + 1}])" for k in range(len(CLASSES)))}] as r1, [{", ".join(f"sum(h2[{k + 1}])" for k in range(len(WORDS) + 1))}] as r2 from f where lang is not null and not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) group by lang),
rs as (select list_transform(r1, lambda x: x / list_sum(r1)) as r1, list_transform(r2, lambda x: x / list_sum(r2)) as r2 from rf),
p as (select *, case when list_sum(h1) > 0 then list_transform(h1, lambda x: x / list_sum(h1)) end as p1, case when list_sum(h2) > 0 then list_transform(h2, lambda x: x / list_sum(h2)) end as p2 from f),
j as (select p.doc_id, min({_apart("p1", "r1")}) as d1, min({_apart("p2", "r2")}) as d2 from p cross join rs group by p.doc_id)
select p.doc_id, n_words, n_chars - space as word_chars, symbol as n_symbols, n_dup_lines, n_repeat_words, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and not (n_words >= {MIN_WORDS_CLASSES} and coalesce(d1, 0) > {MAX_CLASS_DISTANCE}::double) and not (n_words >= {MIN_WORDS_COMMON} and coalesce(d2, 0) > {MAX_COMMON_DISTANCE}::double) as kept
from p left join j using (doc_id)"""

def _round(k: int, book: str) -> str:
    """Nearest entries a{k} of all parts in a codebook."""
    far = "list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    return f"a{k} as materialized (select rid, part, min({{'d': {far}, 'entry': b.entry}}) as best from p join {book} b using (part) group by rid, part)"


def _means(k: int) -> str:
    """The codebook b{k + 1} of b{k} and the parts assigned in a{k}: floors of means; unused entries stay."""
    mean = "(sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*)"
    values = f"select part, best.entry as entry, unnest(x) as v, unnest(range(1, len(x) + 1)) as pos from a{k} join p using (rid, part)"
    return f"b{k + 1} as materialized (select part, entry, coalesce(m.x, b{k}.x) as x from b{k} left join (select part, entry, list(v order by pos) as x from (select part, entry, pos, ({mean})::bigint as v from ({values}) group by all) group by all) m using (part, entry))"


OP12 = f"""with v as materialized (select row_number() over (order by vec_id) as rid, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as x from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
p as materialized (select rid, part, x[len(x) * part // 4 + 1:len(x) * (part + 1) // 4] as x from v, (select unnest(range(4)) as part)),
b0 as materialized (select part, rid - 1 as entry, x from p where rid <= 256),
{", ".join(f"{_round(k, f'b{k}')}, {_means(k)}" for k in range(4))}, {_round(4, "b4")},
h as (select sha256(string_agg(array_to_string(x, ','), ',' order by part, entry)) as codebooks_sha256 from b4),
c as (select rid, string_agg(format('{{:02x}}', best.entry), '' order by part) as code, sum(best.d)::bigint as error from a4 group by rid)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from c join v using (rid), h"""

OP13 = """with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') as u, sha256('42:' || doc_id) as h from documents),
e as (select doc_id, t, u, len(u) as n, ('0x' || h[1:8])::bigint % (len(u) + 1) as c1, ('0x' || h[9:16])::bigint % (len(u) + 1) as c2, ('0x' || h[17:24])::bigint % 100 as r, ('0x' || h[25:32])::bigint % 100 as s from d),
f as (select *, case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or r >= 50 then 'plain' when s < 80 then 'spm' else 'psm' end as form,
  array_to_string(u[1:least(c1, c2)], '') as a, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') as m, array_to_string(u[greatest(c1, c2) + 1:n], '') as z from e)
select doc_id, n, form, case when form <> 'plain' then length(a) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
sha256(case form when 'plain' then t when 'psm' then '<P>' || a || '<S>' || z || '<M>' || m else '<S>' || z || '<P>' || a || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256 from f"""

ORACLES = {"op4_jaccard": OP4, "op6_quality": OP6, "op11_minhash": OP11, "op12_vector_codes": OP12, "op13_fill_middle": OP13}
