"""DuckDB SQL of the core queries, over the same whole tables."""

from __future__ import annotations

from corpusmill.functions.text import FOLD_FROM, FOLD_TO
from corpusmill.operators import judge, language, quality
from corpusmill.operators.minhash import BANDS, PRIME, ROWS, coefficients
from corpusmill.plans.queries import FILE_ROWS, SEED, SHARD_ROWS

_WS = r"[ \t\n\x0B\f\r]"


def _clean(text: str) -> str:
    plain = f"translate(replace(replace(replace(lower(coalesce({text}, '')), 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'), '{FOLD_FROM}', '{FOLD_TO}')"
    plain = rf"regexp_replace(regexp_replace({plain}, 'http[^ \t\n\x0B\f\r]+', '', 'g'), '[^a-z0-9 \t\n\x0B\f\r,.!?'']', '', 'g')"
    plain = f"trim(regexp_replace({plain}, '{_WS}+', ' ', 'g'))"
    return f"case when len(string_split({plain}, ' ')) > 4 then {plain} else '' end"


def _host(url: str) -> str:
    return rf"nullif(lower(regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)', 1)), '')"


def _fqdn(url: str) -> str:
    h = _host(url)
    return rf"coalesce(case when contains({h}, '.') and not regexp_full_match({h}, '[0-9]+(\.[0-9]+)+') and not starts_with({h}, '[') then {h} end, '')"


def _domain() -> str:
    return rf"coalesce(nullif(lower(regexp_replace(domain, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')), ''), {_host('url')})"


def _md5(*columns: str) -> str:
    return "md5(" + " || '|' || ".join(f"coalesce({c}, 'nan')" for c in columns) + ")"


def _of_docs(expression: str) -> str:
    return f"select doc_id, {expression} as value from documents"


def _hashed(key: str) -> str:
    return f"md5('{SEED}|' || coalesce({key}::varchar, 'nan'))"


_SCORE = "case when regexp_full_match(trim(reply), '[0-9]+') and try_cast(trim(reply) as integer) between 0 and 5 then try_cast(trim(reply) as integer) else -1 end"
_JUDGED = """judged as (
  select doc_id, source, text, case doc_id % 10 when 0 then null when 1 then '-1' when 2 then '4分' when 3 then ' 3 ' when 4 then '' else (doc_id % 10 - 4)::varchar end as reply from documents
)"""
_PREDICTED = """predicted as (
  select *, case when prob >= 0.5 then '__label__1' else '__label__0' end as label, greatest(prob, 1 - prob) as p
  from predictions where not isnan(prob) and prob between 0 and 1
)"""


def _distribution(group: str, source: str) -> str:
    keys = f"{group}, " if group else ""
    on = f"and v.{group} is not distinct from g.{group}" if group else ""
    groups = f"(select distinct {group} from {source})" if group else f"(select 1 from {source} limit 1)"
    return f"""
with {_JUDGED}, scored as (select doc_id, source, {_SCORE} as score from judged),
bins as (select unnest([-1, 0, 1, 2, 3, 4, 5])::integer as score),
counted as (
  select {("g." + group + ", ") if group else ""}b.score, count(v.doc_id) as count,
    (select count(*) from scored v where v.score >= 0 {on}) as valid, (select count(*) from scored v where true {on}) as n
  from {groups} g cross join bins b left join scored v on v.score = b.score {on} group by {("g." + group + ", ") if group else ""}b.score
)
select {keys}score, count, coalesce(round(100.0 * count / nullif(case when score < 0 then n else valid end, 0), 2), 0) as percent from counted
"""


_RATIO = "round(coalesce(({0})::double / nullif({1}, 0), 0), 6)"
_TRIM_LINE = r"regexp_replace(x, '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g')"


def _lines(text: str) -> str:
    return f"list_filter(list_transform(string_split({text}, chr(10)), lambda x: {_TRIM_LINE}), lambda x: x <> '')"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_WS}+'), lambda w: w <> '')"


def _share(part: str, whole: str) -> str:
    return f"coalesce(({part})::double / nullif({whole}, 0), 0)"


_CHARS = "coalesce(list_sum(list_transform({0}, lambda x: length(x))), 0)"


def _low_quality(text: str) -> str:
    w, ln = _words(text), _lines(text)
    n, nl = f"len({w})", f"len({ln})"
    mean = _share(_CHARS.format(w), n)
    marks = f"greatest(len(regexp_extract_all({text}, '#')), len(regexp_extract_all({text}, '\\.\\.\\.|…')))"
    stop = ", ".join(f"'{s}'" for s in quality.STOP_WORDS)
    return f"""coalesce({n} < 50 or {n} > 100000 or {mean} < 3 or {mean} > 10 or {_share(marks, n)} > 0.1
  or {_share(f"len(list_filter({ln}, lambda x: regexp_matches(x, '^[•‣*-]')))", nl)} > 0.9
  or {_share(f"len(list_filter({ln}, lambda x: regexp_matches(x, '(\\.\\.\\.|…)$')))", nl)} > 0.3
  or {_share(f"len(list_filter({w}, lambda x: regexp_matches(x, '\\pL')))", n)} < 0.8
  or len(list_intersect(list_distinct(list_transform({w}, lambda x: lower(x))), [{stop}])) < 2, true)"""


def _c4(text: str) -> str:
    plain = rf"regexp_replace({text}, '\[[0-9]*\]|\[edit\]|\[citation needed\]', '', 'g')"
    keep = f"len({_words('x')}) >= 3 and not contains(lower(x), 'javascript') and not regexp_matches(lower(x), '{quality.POLICY}')"
    return f"case when {text} is not null then coalesce(array_to_string(list_filter({_lines(plain)}, lambda x: {keep.replace('lambda w', 'lambda w')}), chr(10)), '') end"


def _c4_bad(text: str, rewritten: str) -> str:
    sentences = rf"len(regexp_extract_all({rewritten}, '[.!?]+(?:[ \t\n\x0B\f\r]|$)'))"
    return f"coalesce(contains(lower({text}), 'lorem ipsum') or contains({text}, '{{') or {sentences} < 5, true)"


def _fineweb(text: str) -> str:
    ln = _lines(text)
    n, total, once = f"len({ln})", _CHARS.format(ln), _CHARS.format(f"list_distinct({ln})")
    end = _share(f"len(list_filter({ln}, lambda x: regexp_matches(x, '[.!?\"''”]$')))", n)
    short = _share(f"len(list_filter({ln}, lambda x: length(x) < 30))", n)
    return f"coalesce({n} = 0 or {end} <= 0.12 or {short} >= 0.67 or {_share(f'{total} - {once}', total)} >= 0.1, true)"


def _repetition() -> str:
    """Repetition shares with n-grams as rows of words and their positions."""
    parts = []
    for name, sep in (("line", "chr(10)"), ("paragraph", "chr(10) || chr(10)")):
        trimmed = f"list_filter(list_transform(string_split(text, {sep}), lambda x: {_TRIM_LINE}), lambda x: x <> '')"
        parts.append(f"{name}s as (select doc_id, {trimmed} as p from documents)")
        shares = f"{_share('len(p) - len(list_distinct(p))', 'len(p)')} as dup_{name}s, {_share(f'{_CHARS.format("p")} - {_CHARS.format("list_distinct(p)")}', _CHARS.format('p'))} as dup_{name}_chars"
        parts.append(f"{name}_shares as (select doc_id, {shares} from {name}s)")
    parts.append(f"split as (select doc_id, {_words('text')} as w from documents where text is not null)")
    parts.append("token as (select doc_id, unnest(w) as w, unnest(range(len(w))) as i from split)")
    parts.append("total as (select doc_id, sum(length(w)) as chars from token group by doc_id)")
    sizes = [*quality.TOP_NGRAMS, *quality.DUPLICATE_NGRAMS]
    for n in sizes:
        parts.append(f"g{n} as (select doc_id, unnest(range(len(w) - {n - 1})) as i, w from split where len(w) >= {n})")
        parts.append(f"k{n} as (select doc_id, i, list_slice(w, i + 1, i + {n}) as gram from g{n})")
        parts.append(f"c{n} as (select doc_id, i, gram, count(*) over (partition by doc_id, gram) as c from k{n})")
        if n in quality.TOP_NGRAMS:
            best = f"select doc_id, gram, c, max(c) over (partition by doc_id) as most from c{n}"
            parts.append(f"s{n} as (select doc_id, max(c * {_CHARS.format('gram')}) as chars from ({best}) where c = most and most > 1 group by doc_id)")
        else:
            parts.append(f"h{n} as (select distinct doc_id, i + unnest(range({n})) as i from c{n} where c > 1)")
            parts.append(f"s{n} as (select t.doc_id, sum(length(t.w)) as chars from token t join h{n} using (doc_id, i) group by t.doc_id)")
    names = {n: f"top_{n}" if n in quality.TOP_NGRAMS else f"dup_{n}" for n in sizes}
    limits = quality.TOP_NGRAMS | quality.DUPLICATE_NGRAMS
    columns = ", ".join(f"coalesce(s{n}.chars::double / total.chars, 0) as {name}" for n, name in names.items())
    joins = " ".join(f"left join s{n} using (doc_id)" for n in sizes)
    parts.append(f"shares as (select d.doc_id, coalesce(dup_lines, 0) as dup_lines, coalesce(dup_line_chars, 0) as dup_line_chars, coalesce(dup_paragraphs, 0) as dup_paragraphs, coalesce(dup_paragraph_chars, 0) as dup_paragraph_chars, {columns} from documents d left join line_shares using (doc_id) left join paragraph_shares using (doc_id) left join total using (doc_id) {joins})")
    broken = " or ".join(["dup_lines > 0.3", "dup_paragraphs > 0.3", "dup_line_chars > 0.2", "dup_paragraph_chars > 0.2", *(f"{name} > {limits[n]}" for n, name in names.items())])
    rounded = ", ".join(f"round({c}, 6) as {c}" for c in ["dup_lines", "dup_line_chars", "dup_paragraphs", "dup_paragraph_chars", *names.values()])
    return f"with {', '.join(parts)}, repetition as (select doc_id, {rounded}, {broken} as repetitive from shares)"


_CASCADE = (
    _repetition()
    + f""", rewritten as (select doc_id, text, lang, {_c4("text")} as c4 from documents), staged as (
  select r.doc_id, case when coalesce(lower(split_part(lang, '-', 1)) <> 'en', true) then 'language' when p.repetitive then 'repetition'
    when {_low_quality("text")} then 'quality' when {_c4_bad("text", "c4")} then 'c4' when {_fineweb("c4")} then 'fineweb' end as reject_stage
  from rewritten r join repetition p using (doc_id)
)"""
)

_PAIRS = coefficients()
_SIGNATURE = f"""
with recursive split as (
  select doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda w: w <> '') as w from documents where text is not null
), grams as (
  select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as gram from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from split where len(w) >= 5)
), hashed as (
  select distinct doc_id, (('0x' || sha1(gram)[1:8])::ubigint & {PRIME})::bigint as h from grams
), signed as (
  select doc_id, [{", ".join(f"min((h * {a} + {b}) % {PRIME})" for a, b in _PAIRS)}] as signature from hashed group by doc_id
), banded as (
  select doc_id, unnest(range({BANDS})) as band, signature from signed
), keyed as (
  select doc_id, band, list_slice(signature, band * {ROWS} + 1, band * {ROWS} + {ROWS}) as key from banded
), firsts as (
  select band, key, min(doc_id) as a from keyed group by band, key
), pairs as (
  select distinct f.a, k.doc_id as b from keyed k join firsts f on f.band = k.band and f.key = k.key where k.doc_id <> f.a
), links as (select a, b from pairs union select b, a from pairs),
reach(id, label) as (
  select a, a from links
  union
  select l.b, r.label from reach r join links l on l.a = r.id
), clusters as (select id, min(label) as label from reach group by id)
"""

_HOSTS = f"hosts as (select {_fqdn('url')} as domain, count(*) as count from crawl_records group by 1)"
_URLS = "urls as (select regexp_replace(url, '[?#].*$', '') as url, count(*) as count from crawl_records where url is not null group by 1)"
_BOTH_TEXTS = "(select text from documents union all select text from filtered_corpus)"
_GROUPED = "select doc_id, source, text from documents where source is not null"
_SAMPLE = f"""
with rows as ({_GROUPED}), ranked as (
  select *, row_number() over (partition by source order by {_hashed("doc_id")}) as r, {_hashed("doc_id")} as o, (select count(distinct source) from rows) as g from rows
), kept as (
  select * from ranked where r <= least(200 // g + 20, 200) and text is not null order by o limit 200
)
"""

# records with keys that an earlier run, of the documents declared German, hadn't taken
_FRESH = f"""
with known as (select distinct coalesce(url, 'nan') || '|' || coalesce(text, 'nan') as k from documents where starts_with(lower(lang), 'de')),
fresh as (
  select coalesce(url, 'nan') || '|' || text as k, min(doc_id) as doc_id from documents where length(text) > 20 and length(text) < 100000 group by 1
),
placed as (select doc_id, (row_number() over (order by doc_id) - 1) // {SHARD_ROWS} as n from fresh where k not in (select k from known))
"""
_KEYWORD_SCORE = "least(5, " + " + ".join(f"contains(lower(coalesce(text, '')), '{k}')::integer" for k in judge.KEYWORDS) + ")"


def _guess_language() -> str:
    hits = {lang: "len(list_filter(w, lambda x: x in (" + ", ".join(f"'{s}'" for s in stop) + ")))" for lang, stop in language.STOP_WORDS.items()}
    counts = ", ".join(f"coalesce({h}, 0) as h_{lang}" for lang, h in hits.items())
    best = "greatest(" + ", ".join(f"h_{lang}" for lang in hits) + ")"
    name = " ".join(f"when h_{lang} = {best} then '{lang}'" for lang in hits)
    return f"""words as (select doc_id, lang, text, regexp_extract_all(lower(text), '[\\pL]+') as w from documents),
hits as (select doc_id, lang, text, {counts} from words),
guessed as (select doc_id, lang, text, case when {best} > 0 then case {name} end end as language from hits)"""


_GUESSED = _guess_language()

SQL: dict[str, str] = {
    "minimum_slice": f"select lang, count(distinct clean) as docs from (select lang, {_clean('text')} as clean from documents where length(text) between 20 and 100000) where clean <> '' group by lang",
    "clean_text": _of_docs(_clean("text")),
    "clean_whitespace": _of_docs(f"trim(regexp_replace(coalesce(text, ''), '{_WS}+', ' ', 'g'))"),
    "flatten_newlines": _of_docs("replace(text, chr(10), ' ')"),
    "clean_filename": _of_docs(r"regexp_replace(url, '[^\pL\pN._]', '', 'g')"),
    "truncate_text": _of_docs(r"case when length(text) <= 500 then text else trim(regexp_extract(left(text, 500), '(?s)^.*\.', 0)) end"),
    "word_count": _of_docs(r"coalesce(len(regexp_extract_all(lower(text), '[\pL\pN_]+(?:-+[\pL\pN_]+)*')), 0)"),
    "dedup_hash_md5": _of_docs(_md5("url", "text")),
    "dedup_hash_sha": _of_docs("sha256(coalesce(url, 'nan') || '|' || coalesce(text, 'nan'))"),
    "label_lines": _of_docs(r"trim('__label__1 ' || regexp_replace(coalesce(text, ''), '[\r\n]+', ' ', 'g'))"),
    "fqdn": _of_docs(_fqdn("url")),
    "mask_addresses": _of_docs(r"regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}', 'email@example.com', 'g'), '\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b', '192.0.2.1', 'g')"),
    "html_text": _of_docs(
        "trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(text, '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '"
        + _WS
        + "+', ' ', 'g'))"
    ),
    "scan_roundtrip_csv": "select doc_id, length(text) as chars, md5(text) as digest from documents where text is not null and text <> ''",
    "scan_roundtrip_jsonl": "select doc_id, url, text, lang from documents",
    "scan_roundtrip_zst": "select doc_id, url, text, lang from documents",
    "scan_bad_json": "select case when doc_id % 10 = 0 then 'bad' else 'good' end as kind, count(*) as rows from documents group by 1",
    "scan_bad_rows": "select doc_id from documents where doc_id % 10 <> 0",
    "label_line_roundtrip": r"""
with lines as (select '__label__' || (doc_id % 2) as label, trim(regexp_replace(coalesce(text, ''), '[\r\n]+', ' ', 'g')) as rest from documents)
select rest <> '' as ok, label, count(*) as lines from lines group by 1, 2""",
    "parse_label_lines": """
with lines as (select trim(case when doc_id % 7 = 0 then 'x y' when doc_id % 11 = 0 then '__label__0' else '__label__1 ' || source || ' ' || lang end) as v from documents)
select split_part(v, ' ', 1) as label, case when contains(v, ' ') then substr(v, instr(v, ' ') + 1) end as text, contains(v, ' ') and starts_with(v, '__label__') as ok from lines where coalesce(v, '') <> ''""",
    "file_chunk_assign": f"select doc_id, (row_number() over (order by doc_id) - 1) // {FILE_ROWS} + 1 as file_no from documents",
    "shard_assign": f"select doc_id, printf('shard_%02d/shard_%05d.jsonl.zst', n % 10 + 1, n // 10 + 1) as shard from (select doc_id, (row_number() over (order by doc_id) - 1) // {SHARD_ROWS} as n from documents)",
    "chunk_assign": "select event_id, (row_number() over (order by event_id) - 1) // 1000 + 1 as chunk from events",
    "even_split": "select item_id, ntile(7) over (order by item_id)::integer as part from benchmark",
    "len_filter": "select doc_id from documents where length(text) between 20 and 100000",
    "len_filter_strict": "select doc_id from documents where length(text) > 20 and length(text) < 100000",
    "language_filter": "select doc_id from documents where lower(split_part(lang, '-', 1)) = 'en'",
    "discovered_folders": "select 'l=' || coalesce(lower(lang), 'none') as folder, count(*) as rows from documents where coalesce(lang, 'none') <> '' group by 1",
    "long_text": "select distinct text from documents where length(text) between 3000 and 100000",
    "score_filter": "select distinct prob, text, url from predictions where length(text) between 20 and 100000 and not isnan(prob) and prob between 0.2 and 0.9",
    "prob_filter": "select pred_id from predictions where not isnan(prob) and prob >= 0.9",
    "prob_filter_stats": f"select count(*) as total, count_if(not isnan(prob) and prob >= 0.9) as kept, {_RATIO.format('count_if(not isnan(prob) and prob >= 0.9)', 'count(*)')} as ratio from predictions",
    "positive_filter": f"with {_PREDICTED} select pred_id from predicted where label = '__label__1' and p > 0.9",
    "pos_neg_split": f"with {_PREDICTED} select replace(label, '__label__', '') as label, count(*) as n from predicted group by 1",
    "domain_filter": f"select record_id from crawl_records where {_domain()} in (select domain from keep_targets)",
    "score_validate": f"with {_JUDGED} select doc_id, {_SCORE} as score from judged",
    "rescore_candidates": f"with {_JUDGED} select doc_id from judged where coalesce(try_cast(trim(reply) as double) not between 0 and 5, true)",
    "gopher_repetition": _repetition() + " select * from repetition",
    "gopher_quality": f"select doc_id, {_low_quality('text')} as low_quality from documents",
    "c4_quality": f"select doc_id, c4 as text, {_c4_bad('text', 'c4')} as bad from (select doc_id, text, {_c4('text')} as c4 from documents)",
    "fineweb_quality": f"select doc_id, {_fineweb('text')} as bad from documents",
    "filter_cascade": _CASCADE + " select doc_id, reject_stage from staged",
    "cascade_report": _CASCADE + " select coalesce(reject_stage, 'kept') as stage, count(*) as docs from staged group by 1",
    "reject_sink": _CASCADE + " select reject_stage, count(*) as rows from staged where reject_stage is not null group by 1",
    "dedup_text": "select min(doc_id) as doc_id from documents group by text",
    # NaN is a missing value like null
    "dedup_rows": "select distinct pred_id, domain, case when not isnan(prob) then prob end as prob from predictions",
    "dedup_metrics": "select sum(n)::bigint as total, (sum(n) - count(*))::bigint as duplicated, count(*) as remain from (select text, count(*) as n from documents group by text)",
    "dedup_stats": f"""
with keyed as (select coalesce(length(text) > 20 and length(text) < 100000, false) as ok, {_md5("url", "text")} as k from documents)
select count(*) as processed, count_if(not ok) as length_errors, (count_if(ok) - count(distinct case when ok then k end))::bigint as duplicates,
  count(distinct case when ok then k end) as unique_rows, {_RATIO.format("count_if(ok) - count(distinct case when ok then k end)", "count_if(ok)")} as rate from keyed""",
    "dedup_cross": "select min(doc_id) as doc_id from documents where length(text) > 20 and length(text) < 100000 and text not in (select text from filtered_corpus where text is not null) group by text",
    "bloom_shard": "select seen_key, (('0x' || sha256(seen_key)[1:16])::ubigint % 2000)::bigint as shard from seen_keys",
    "bloom_check": """
with asked as (select request_id, unnest(elements) as key, unnest(range(len(elements)))::integer as pos from check_requests)
select request_id, pos, key is not null and key in (select seen_key from seen_keys where seen_key is not null) as known from asked""",
    "registry_status": "select (('0x' || sha256(seen_key)[1:16])::ubigint % 2000)::bigint as shard, count(*) as keys from seen_keys group by 1",
    "registry_add": """
select (('0x' || sha256(key)[1:16])::ubigint % 2000)::bigint as shard, count(*) as keys
from (select seen_key as key from seen_keys union select unnest(elements) from check_requests) where key is not null group by 1""",
    "minhash_signature": _SIGNATURE + "select doc_id, signature from signed",
    "minhash_signature_fast": _SIGNATURE + "select doc_id, signature from signed",
    "minhash_pairs": _SIGNATURE + "select a, b from pairs",
    "minhash_clusters": _SIGNATURE + "select id, label from clusters",
    "minhash_dedup": _SIGNATURE + "select doc_id from documents where doc_id not in (select id from clusters where id <> label)",
    "union_merge": "select 'documents' as \"table\", count(*) as rows, count(lang) as with_lang from documents union all select 'benchmark', count(*), 0 from benchmark",
    "merge_dataset": f"select distinct text from (select {_clean('text')} as text from {_BOTH_TEXTS} where length(text) between 20 and 100000) where text <> ''",
    "merge_train_data": f"select distinct text from (select {_clean('text')} as text from {_BOTH_TEXTS}) where text <> ''",
    "remove_overlap": "select doc_id from documents d where not exists (select 1 from filtered_corpus f where f.text is not distinct from d.text)",
    "remove_cleaned": f"select doc_id from documents where {_clean('text')} not in (select {_clean('text')} from filtered_corpus)",
    "url_count": f"with {_URLS} select url, count from urls where url <> ''",
    "domain_count": f"with {_HOSTS} select domain, count from hosts where domain <> ''",
    "domain_count_by_file": f"select source, {_fqdn('url')} as domain, count(*) as count from documents where source <> '' and {_fqdn('url')} <> '' group by 1, 2",
    "domain_rollup": f"with {_URLS} select {_fqdn('url')} as domain, sum(count)::bigint as count from urls where {_fqdn('url')} <> '' group by 1",
    "domain_merge": f"select domain, count(*) as count from (select {_fqdn('url')} as domain from crawl_records union all select {_fqdn('url')} from documents) where domain <> '' group by 1",
    "top_domains": f"with {_HOSTS} select domain, count from hosts where domain <> '' order by count desc, domain limit 5",
    "domain_ratio": f"""
with {_HOSTS}, base as (select {_fqdn("url")} as domain, count(*) as count from crawl_records where starts_with(url, 'https') group by 1)
select b.domain, b.count as base_count, h.count as other_count, round(b.count::double / h.count, 6) as ratio from base b join hosts h using (domain) where b.domain <> ''""",
    "score_distribution": _distribution("", "documents"),
    "score_by_source": _distribution("source", "documents"),
    "confusion_matrix": f"""
with truth as (select doc_id, bool_or(lower(subject) = 'transport') as t from subject_labels group by doc_id),
scored as (select doc_id, max(case when not isnan(prob) then prob end) as p from predictions where doc_id is not null group by doc_id),
rows as (select t, coalesce(p > 0.9, false) as g from scored left join truth using (doc_id)),
cells as (select count(*) as total, count_if(t and g) as tp, count_if(not t and g) as fp, count_if(t and not g) as fn, count_if(not t and not g) as tn from rows)
select *, {_RATIO.format("tp", "tp + fp")} as precision, {_RATIO.format("tp", "tp + fn")} as recall, {_RATIO.format("(2 * tp)", "2 * tp + fp + fn")} as f1, {_RATIO.format("(tp + tn)", "tp + fp + fn + tn")} as accuracy from cells""",
    "inference_report": f"with {_PREDICTED} select count(*) as total, count_if(label = '__label__1' and p > 0.9) as positives, {_RATIO.format("count_if(label = '__label__1' and p > 0.9)", 'count(*)')} as share from predicted",
    "sample_per_group": _SAMPLE + "select doc_id from kept",
    "sample_clean": _SAMPLE + f"select doc_id, clean as text from (select doc_id, {_clean('text')} as clean from kept) where clean <> ''",
    "stratified_bins": """
with binned as (select ceil((value / 100)::decimal(20,10) / 0.3)::integer as bin from events where value > 0),
bins as (select unnest(range(1, 11))::integer as bin)
select b.bin, count(x.bin) as rows, (50 + case when b.bin <= 3 then 1 else 0 end)::bigint as quota from bins b left join binned x using (bin) group by b.bin""",
    "train_val_split": f"""
with ranked as (select doc_id, row_number() over (partition by lang order by {_hashed("doc_id")}) as r, count(*) over (partition by lang) as n from documents)
select doc_id, case when r <= round(n * 0.8) then 'train' else 'val' end as split from ranked""",
    "segment_invariants": r"""
select doc_id, n as tokens from (select doc_id, len(list_filter(regexp_split_to_array(text, '[\t-\r\x1C-\x20\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'), lambda w: w <> '')) as n
from documents where text is not null) where n > 0""",
    "append_csv": "select task, count(*) as rows from benchmark group by task",
    "convert_jsonl_csv": "select item_id, task from benchmark",
    "failed_files": "select item_id from benchmark union all select -1 union all select -1",
    "pipeline_dedup": _FRESH + "select printf('shard_%02d', n % 10 + 1) as folder, printf('shard_%05d', n // 10 + 1) as shard, count(*) as rows from placed group by 1, 2",
    "pipeline_shards": _FRESH + "select doc_id, printf('shard_%02d/shard_%05d.jsonl.zst', n % 10 + 1, n // 10 + 1) as shard from placed",
    "csv_dedup": "select count(*) as total, count(*) - count(distinct text) as duplicated, count(distinct text) as remain, count(distinct text) as written from documents where length(text) > 20 and length(text) < 100000",
    "csv_merge": "select task, count(*) as rows from benchmark group by task",
    "scan_bad_rows_rejected": "select case when doc_id % 10 = 0 then 'bad' else 'good' end as kind, count(*) as rows from documents group by 1",
    "scan_json_array": "select item_id, task from benchmark",
    "unprocessed_files": "select distinct source as path from documents where source is not null and source not in (select metadata['source'] from filtered_corpus where metadata['source'] is not null)",
    "pos_neg_outputs": f"with {_PREDICTED} select case when label = '__label__1' and p > 0.9 then 'positive' else 'negative' end as side, count(*) as rows from predicted group by 1",
    "url_filter": f"""
with hosts as (select lower(domain) as h from keep_targets where domain <> '*'),
banned as (select distinct u.host from (select distinct {_host("url")} as host from crawl_records) u join hosts on u.host = h or ends_with(u.host, '.' || h))
select record_id from crawl_records where coalesce({_host("url")} not in (select host from banned), true) and not coalesce(contains(lower(url), 'tag') or contains(lower(url), 'login'), false)""",
    "token_count": _of_docs(r"coalesce(len(regexp_extract_all(text, '[\pL\pN]+|[^\pL\pN \t\n\x0B\f\r]')), 0)"),
    "guess_format": _of_docs("case when contains(lower(url), 'jsonl') then 'jsonl' when contains(lower(url), 'parquet') then 'parquet' when contains(lower(url), 'warc') then 'warc' else 'csv' end"),
    "precision_at_one": """
with truth as (select doc_id, bool_or(lower(subject) = 'transport') as t from subject_labels group by doc_id),
scored as (select doc_id, max(case when not isnan(prob) then prob end) as p from predictions where doc_id is not null group by doc_id),
rows as (select t, p > 0.9 as g from scored join truth using (doc_id) where t is not null)
select count(*) as samples, round(coalesce(count_if(t = g)::double / nullif(count(g), 0), 0), 6) as precision, round(coalesce(count_if(t = g)::double / nullif(count(*), 0), 0), 6) as recall from rows""",
    "stratified_sample": f"""
with binned as (select event_id, ceil((value / 100)::decimal(20,10) / 0.3)::integer as bin from events where value > 0),
kept as (select * from binned where bin between 1 and 10),
ranked as (select *, row_number() over (partition by bin order by {_hashed("event_id")}) as r, count(*) over (partition by bin) as n, 50 + (bin <= 3)::integer as quota from kept)
select event_id, bin, unnest(range(1, (quota - r) // n + 2))::integer as draw from ranked where r <= quota""",
    "judge_scores": f"select doc_id, {_KEYWORD_SCORE} as score from documents",
    "judge_rescored": f"""
with {_JUDGED} select doc_id, case when try_cast(trim(reply) as double) between 0 and 5 then try_cast(trim(reply) as double)::integer else {_KEYWORD_SCORE} end as score from judged""",
    "language_id_eval": f"with {_GUESSED} select lower(split_part(lang, '-', 1)) as lang, language, count(*) as docs from guessed where text is not null group by 1, 2",
    "rejects_by_language": f"with {_GUESSED} select coalesce(language, 'none') as language, count(*) as rows from guessed where language is distinct from 'en' group by 1",
    "domain_corpus": f"select distinct md5(text) as digest from documents where length(text) between 20 and 100000 and {_fqdn('url')} in (select {_fqdn('url')} from documents group by 1 having count(*) >= 10 and {_fqdn('url')} <> '')",
}
