"""SQL expressions of DuckDB for the checks of the registered queries."""

from __future__ import annotations

from leafmill.functions import values as V

#: The same white space, as this regular-expression engine writes it (fixed values).
SPACE = r"\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
ATTR, ATTR1 = "{0,1000}", "{1,1000}"
#: Tags that the class rule spells out here, for want of back references.
CLASSED = ("div", "p", "section", "aside", "span", "ul", "li", "a")


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, by: str = " ", flags: str = "g") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(by)}, '{flags}')"


def trim(x: str) -> str:
    return sub(x, f"^[{SPACE}]+|[{SPACE}]+\\z", "")


def squeeze(x: str) -> str:
    return trim(sub(x, f"[{SPACE}]+"))


def first(x: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({x}, {lit(pattern)}, {group}), '')"


def decode_entities(x: str) -> str:
    table = "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in V.ENTITIES.items()) + "}"
    found = f"regexp_extract(p, {lit('(?i)' + V.ENTITY)}, 0)"
    name = f"lower(replace({found}, ';', ''))"
    rest = f"substr(p, length({found}) + 1)"
    code = f"(case when {name} like '#x%' then try_cast('0x' || substr({name}, 3) as bigint) when {name} like '#%' then try_cast(substr({name}, 2) as bigint) end)"
    value = f"(case when {name} like '#%' then (case when {code} <= 1114111 then chr({code}::int) end) else {table}[{name}] end)"
    one = f"(case when {found} = '' or {value} is null then '&' || p else {value} || {rest} end)"
    parts = f"string_split({x}, '&')"
    return f"(case when contains({x}, '&') then {parts}[1] || array_to_string(list_transform({parts}[2:], lambda p: {one}), '') else {x} end)"


def defuse(x: str) -> str:
    tail = f"string_split({x}, '>')[-1]"
    return f"(case when length({tail}) >= {V.STRAY_TAIL} and contains({tail}, '<') then left({x}, length({x}) - length({tail})) || replace({tail}, '<', ' ') else {x} end)"


def untag(x: str) -> str:
    return sub(x, f"<[^>]{ATTR1}>")


def text_only(x: str) -> str:
    x = sub(x, "<!--.*?-->", flags="gs")
    for t in V.TEXT_TAGS:
        x = sub(x, f"<{t}[\\s>].*?</{t}{chr(92) + 's*' if t == 'textarea' else ''}>", flags="gis")
    return decode_entities(trim(sub(untag(x), "[ \\t\\r\\n]+")))


def reveal_escaped(x: str) -> str:
    x = sub(x, "&lt;(/?[a-zA-Z!])", "<\\1", "gi")
    return sub(sub(x, "&gt;", ">", "gi"), "&quot;", '"', "gi")


def strip_noise(x: str) -> str:
    x = sub(x, "<!--.*?-->", flags="gs")
    x = sub(x, "|".join(f"<{t}[\\s>].*?</{t}\\s*>" for t in V.RAW_TAGS), flags="gis")
    x = sub(x, "|".join(f"<{t}[\\s>].*?</{t}>" for t in V.BOX_TAGS), flags="gis")
    noise = f"""class=["'][^"']{{0,300}}(?:{"|".join(V.NOISE_CLASSES)})[^"']{{0,300}}["'][^>]{ATTR}>.*?"""
    return sub(x, "|".join(f"<{t}[^>]{ATTR1}{noise}</{t}>" for t in CLASSED), flags="gis")


def articles(x: str) -> str:
    """The main part of pages that have articles and no main element."""
    return f"array_to_string(regexp_extract_all({x}, '(?is)<article[\\s>].*?</article\\s*>'), chr(10))"


def body_text(x: str) -> str:
    return trim(sub(text_only(strip_noise(reveal_escaped(strip_noise(articles(x))))), " +"))


def title(x: str) -> str:
    raw = f"regexp_extract({x}, {lit(f'(?is)<title[^>]{ATTR}>(.*?)</title>')}, 1)"
    return f"coalesce(nullif({text_only(raw)}, ''), {trim(raw)})"


def language(x: str) -> str:
    return f"regexp_extract({x}, {lit(f'''(?i)<html[^>]{ATTR1}lang=[\"']([A-Za-z0-9_-]+)[\"']''')}, 1)"


def meta(x: str, names: tuple[str, ...]) -> str:
    found = ", ".join(first(x, f"""(?i)<meta[^>]{ATTR1}(?:property|name)=["']{n}["'][^>]{ATTR1}content=["']([^"']+)["']""") for n in names)
    return f"coalesce(left({squeeze(untag(decode_entities(f'coalesce({found})')))}, {V.META_CHARS}), '')"


def escaped(x: str) -> str:
    return f"""array_to_string(list_transform(regexp_extract_all({x}, '(?s).'), lambda c: case when regexp_matches(c, '[^!#-;=?-_a-z|~]') then url_encode(c) else c end), '')"""


def origin(x: str) -> str:
    return f"lower(regexp_extract({x}, '(?i)^(https?://[^/?#]+)', 1))"


def host_of(x: str) -> str:
    return sub(sub(origin(x), "^https?://", ""), ":[0-9]+\\z", "")


def rooted(href: str, base: str) -> str:
    """A reference that starts with a slash, against its page."""
    return f"({origin(base)} || {escaped(href)})"


def normalize(x: str) -> str:
    rest = f"regexp_extract({x}, '(?is)^https?://[^/?#]+([^#]*)', 1)"
    return f"({origin(x)} || {escaped(f'''(case when {rest} = '' or left({rest}, 1) = '?' then '/' else '' end || {rest})''')})"


def join_pages(a: str, b: str) -> str:
    n = f"list_max(list_filter(range({V.OVERLAP_MIN}, least({V.OVERLAP_MAX}, length({a}), length({b})) + 1), lambda k: right({a}, k) = left({b}, k)))"
    rest = trim(f"substr({b}, coalesce({n}, 0) + 1)")
    return f"(case when {n} is null then {a} || chr(10) || chr(10) || {b} when {rest} = '' then {a} else {a} || chr(10) || chr(10) || {rest} end)"


def sentences(x: str, limit: int) -> str:
    """The first whole sentences that fit, else a hard cut."""
    s = f"regexp_extract_all({x}, {lit(V.SENTENCE)})"
    fits = f"list_filter({s}, lambda t, i: list_sum(list_transform({s}[1:i], lambda u: length(u))) <= {limit})"
    return f"coalesce(nullif(array_to_string({fits}, ''), ''), left({x}, {limit}))"


def sliced(x: str, limit: int) -> str:
    """A slice from the start of a text without blank lines."""
    return f"(case when length({x}) <= {limit} then {x} else {sentences(x, limit)} end)"
