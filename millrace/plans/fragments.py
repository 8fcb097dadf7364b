"""Common table expressions that several SQL oracles share."""

from millrace.functions.urls import TRACKING

BLANK = r"[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
INVISIBLE = r"[\x{200B}-\x{200D}\x{2060}\x{FEFF}\x{AD}]"
_ENTITIES = [("&#x27;", "''"), ("&#39;", "''"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&")]
# The cut entity of a control character denotes nothing.
SUMMARY = r"regexp_replace(regexp_replace(feed_summary, '<[^>]+>', ' ', 'g'), '&#x2([^0-9a-fA-F;]|$)', '\1', 'g')"
for _entity, _character in _ENTITIES:
    SUMMARY = f"replace({SUMMARY}, '{_entity}', '{_character}')"

_NAMES = ", ".join(f"'{t}'" for t in TRACKING)


def canonical_ctes(rows: str, name: str) -> str:
    """`name`(k, url, problem): canonical URLs of `rows`, a query of (k, u). Hosts in brackets are taken as they are."""
    return rf"""
    {name}_0 as (select k, regexp_replace(regexp_replace(coalesce(u, ''), '[\x{{200B}}-\x{{200D}}\x{{2060}}\x{{FEFF}}\x{{AD}}]', '', 'g'), '^{BLANK}+|{BLANK}+$', '', 'g') as v from ({rows})),
    {name}_1 as (select k, v, regexp_extract(v, '(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$', ['scheme', 'place', 'path', 'query']) as p,
        regexp_full_match(v, '(?s)[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?') and not regexp_matches(v, '[\x00-\x20\x7F]') as ok from {name}_0),
    {name}_2 as (select k, v, ok and regexp_full_match(p.place, '[^\[\]:@]+(:[0-9]*)?') as ok, lower(p.scheme) as scheme, rtrim(lower(split_part(p.place, ':', 1)), '.') as host,
        case when split_part(p.place, ':', 2) = '' then '' else coalesce(nullif(ltrim(split_part(p.place, ':', 2), '0'), ''), '0') end as port,
        list_reduce(list_transform(string_split(case when starts_with(p.path, '/') then substr(p.path, 2) else p.path end, '/'), lambda s: [s]),
            lambda a, s: case s[1] when '..' then a[1:len(a) - 1] when '.' then a else list_concat(a, s) end, cast([] as varchar[])) as steps,
        list_filter(string_split(p.query, '&'), lambda q: q <> '' and not list_contains([{_NAMES}], lower(split_part(q, '=', 1)))) as query from {name}_1),
    {name}_3 as (select *, '/' || array_to_string(steps, '/') as path from {name}_2),
    {name}_4 as (select *, scheme || '://' || host || case when port = '' or (scheme, port) in (('http', '80'), ('https', '443')) then '' else ':' || port end ||
        array_to_string(list_transform(regexp_extract_all(path, '(?s)%[0-9A-Fa-f]{{2}}|.'), lambda t: case when len(t) = 3 and starts_with(t, '%') then
            case when regexp_matches(chr(('0x' || substr(t, 2))::int), '^[A-Za-z0-9._~-]$') then chr(('0x' || substr(t, 2))::int) else upper(t) end
            when regexp_matches(t, '^[A-Za-z0-9._~/%:@!$&''()*+,;=-]$') then t else url_encode(t) end), '') || case when len(query) > 0 then '?' || array_to_string(query, '&') else '' end as made from {name}_3),
    {name} as (select k, case when v = '' then 'missing' when not ok or scheme not in ('http', 'https') or host = '' or coalesce(try_cast(nullif(port, '') as bigint), 0) > 65535 or length(made) > 2048 then 'invalid' end as problem,
        case when problem is null then made end as url from {name}_4)"""


def paragraph_ctes(rows: str, name: str) -> str:
    """`name`(k, pos, text, section): paragraphs of `rows`, a query of (k, t), fenced ones in one piece."""
    return rf"""
    {name}_0 as (select k, list_reduce(list_transform(string_split(t, chr(10) || chr(10)), lambda x: {{'done': [x], 'fence': cast(null as varchar)}}), lambda a, x:
        case when a.fence is not null and regexp_matches(x.done[1], '```\s*$') then {{'done': list_append(a.done, a.fence || chr(10) || chr(10) || x.done[1]), 'fence': cast(null as varchar)}}
             when a.fence is not null then {{'done': a.done, 'fence': a.fence || chr(10) || chr(10) || x.done[1]}}
             when starts_with(x.done[1], '```') and not (length(regexp_replace(x.done[1], '\s+$', '')) > 3 and regexp_matches(x.done[1], '```\s*$')) then {{'done': a.done, 'fence': x.done[1]}}
             else {{'done': list_append(a.done, x.done[1]), 'fence': cast(null as varchar)}} end, {{'done': cast([] as varchar[]), 'fence': cast(null as varchar)}}) as s from ({rows}) where t is not null),
    {name}_1 as (select k, list_filter(list_transform(case when s.fence is null then s.done else list_append(s.done, s.fence) end, lambda x: regexp_replace(x, '^{BLANK}+|{BLANK}+$', '', 'g')), lambda x: x <> '') as texts from {name}_0),
    {name}_2 as (select k, unnest(range(1, len(texts) + 1))::int as pos, unnest(texts) as text from {name}_1),
    {name} as (select k, pos, text, last_value(case when regexp_matches(text, '^#{{1,6}} [^\n]*$') then nullif(trim(ltrim(text, '#')), '') end ignore nulls) over (partition by k order by pos rows unbounded preceding) as section from {name}_2)"""
