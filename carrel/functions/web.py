"""Web addresses and pages as Column expressions: references resolved as RFC 3986 has it, links with their text, readable text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space of Unicode, as a character class for Java's patterns.
SPACE = r"[\s\x1c-\x1f\u0085   -     　]"
# Schemes in which a relative reference is resolved.
RELATIVE = ["", "http", "https", "ftp", "file", "sftp", "gopher", "nntp", "imap", "wais", "shttp", "mms", "prospero", "rtsp", "svn", "ws", "wss"]
# Tags that start a new line of a page's text.
LINE_TAGS = ["br", "p", "li", "tr", "h1", "h2", "h3", "h4"]
# The commonest named entities; numbers in entities are computed.
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "trade": "™", "middot": "·", "bull": "•", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "sect": "§", "para": "¶", "deg": "°", "plusmn": "±", "times": "×", "le": "≤", "ge": "≥", "micro": "µ", "euro": "€"}

_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def trimmed(x: Column) -> Column:
    return F.regexp_replace(x, f"^{SPACE}+|{SPACE}+$", "")


def address(url: Column) -> dict[str, Column]:
    """scheme (lower case), host, path, query, fragment; '' where missing."""
    s = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    part = lambda k: F.regexp_extract(s, _PARTS, k)
    return {"scheme": F.lower(part(1)), "host": part(2), "path": part(3), "query": part(4), "fragment": part(5)}


def built(scheme: Column, host: Column, path: Column, query: Column, fragment: Column) -> Column:
    after = lambda sign, x: F.when(x != "", F.concat(F.lit(sign), x)).otherwise("")
    rooted = F.when((host != "") & (path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    hosted = (host != "") | ((scheme != "") & scheme.isin(RELATIVE) & ((path == "") | path.startswith("/")))
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), F.when(hosted, F.concat(F.lit("//"), host)).otherwise(""), rooted, after("?", query), after("#", fragment))


def quoted_path(path: Column) -> Column:
    """Percent-coding undone and done again; letters, digits, ``_.-~`` and ``/:@`` stay plain."""
    safe = F.replace(F.regexp_replace(path, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    coded = F.url_encode(F.url_decode(safe))
    for code, sign in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/"), ("%3A", ":"), ("%40", "@")):
        coded = F.replace(coded, F.lit(code), F.lit(sign))
    return coded


def plain_url(url: Column) -> Column:
    """Blanks around it off, unsafe characters of the path percent-coded; query and fragment as they are."""
    a = address(trimmed(F.coalesce(url, F.lit(""))))
    path = without_parameters(a["path"])
    return built(a["scheme"], a["host"], F.concat(quoted_path(path), F.substring(a["path"], F.length(path) + 1, F.length(a["path"]))), a["query"], a["fragment"])


def without_parameters(path: Column) -> Column:
    """A path without what follows a semicolon in its last part."""
    return F.regexp_extract(path, "^((?:.*/)?[^/;]*)", 1)


def _last(path: Column) -> Column:
    return F.regexp_extract(without_parameters(path), "([^/]*)/*$", 1)


def url_extension(url: Column) -> Column:
    """The ending of the path's last part in lower case, or .html."""
    found = F.lower(F.regexp_extract(_last(address(url)["path"]), r"[^.].*?(\.[^.]+)$|^[^.](\.[^.]+)$", 0))
    ending = F.regexp_extract(found, r"(\.[^.]+)$", 1)
    return F.when(ending != "", ending).otherwise(".html")


def file_name(url: Column, title: Column) -> Column:
    """The path's last part, or the title with the address's ending, in safe characters."""
    name = _last(address(url)["path"])
    stem = F.regexp_replace(F.regexp_replace(F.coalesce(title, F.lit("")), "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")
    made = F.concat(F.when(stem == "", "manual").otherwise(stem), url_extension(url))
    return F.regexp_replace(F.when(name != "", name).otherwise(made), "[^A-Za-z0-9._-]+", "_")


def resolved(base: Column, reference: Column) -> Column:
    """A reference against the address of its page: dot segments folded, what is missing taken over."""
    b, r = address(base), address(reference)
    own = (reference == "") | (base == "")
    foreign = ((r["scheme"] != "") & (r["scheme"] != b["scheme"])) | ~b["scheme"].isin(RELATIVE)
    folder = F.split(F.regexp_replace(b["path"], "[^/]*$", ""), "/")
    folder = F.slice(folder, 1, F.size(folder) - 1)
    segments = F.concat(folder, F.split(r["path"], "/"))
    n = F.size(segments)
    inner = F.when(r["path"].startswith("/"), F.split(r["path"], "/")).otherwise(F.filter(segments, lambda s, i: (s != "") | (i == 0) | (i == n - 1)))
    kept = F.aggregate(inner, F.slice(inner, 1, 0), lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.array_append(done, s)))
    kept = F.when(F.element_at(inner, -1).isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    path = F.array_join(kept, "/")
    path = F.when(path == "", "/").otherwise(path)
    same = r["path"] == ""
    joined = built(b["scheme"], b["host"], F.when(same, b["path"]).otherwise(path), F.when(same & (r["query"] == ""), b["query"]).otherwise(r["query"]), r["fragment"])
    whole = built(b["scheme"], r["host"], r["path"], r["query"], r["fragment"])
    return F.when(own, F.when(reference == "", base).otherwise(reference)).when(foreign, reference).when(r["host"] != "", whole).otherwise(joined)


def unescaped(x: Column) -> Column:
    """Entities by number and the common ones by name; others stay."""
    names = F.from_json(F.lit("{" + ",".join(f'"{k}":"{v if v not in chr(34) else chr(92) + v}"' for k, v in ENTITIES.items()) + "}"), "map<string,string>")
    hexed = lambda n: F.when(n < 65536, F.lpad(F.hex(n), 4, "0")).otherwise(F.concat(F.hex(F.lit(0xD800) + F.shiftright(n - 65536, 10)), F.hex(F.lit(0xDC00) + (n - 65536) % 1024)))

    def sign(token: Column) -> Column:
        number = F.when(token.rlike("^&#[0-9]{1,7};?$"), F.regexp_extract(token, "([0-9]+)", 1).try_cast("int")).when(token.rlike("^&#[xX][0-9A-Fa-f]{1,6};?$"), F.conv(F.regexp_extract(token, "[xX]([0-9A-Fa-f]+)", 1), 16, 10).try_cast("int"))
        char = F.when((number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF), F.decode(F.unhex(hexed(number)), "UTF-16BE"))
        return F.coalesce(char, F.when(token.rlike("^&[A-Za-z]+;$"), F.try_element_at(names, F.regexp_extract(token, "([A-Za-z]+)", 1))), token)

    tokens = F.regexp_extract_all(x, F.lit("(?s)&#?[A-Za-z0-9]+;?|[^&]+|&"), F.lit(0))
    return F.when(x.contains("&"), F.array_join(F.transform(tokens, sign), "")).otherwise(x)


#: comments, declarations, scripts and styles with their content, tags, texts
_TOKENS = r"""(?is)<!--.*?-->|<[!?][^>]*>|<(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>|</?[a-z](?:[^>"']|"[^"]*"|'[^']*')*>|[^<]+|<"""


def page_tokens(html: Column) -> Column:
    """An array of (tag, text, raw): lower-case tag name with a slash where it closes, or '' for a text, which is unescaped."""
    raw = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_TOKENS), F.lit(0))

    def token(t: Column) -> Column:
        block = F.regexp_extract(t, r"(?is)^<(?:script|style)\b[^>]*>(.*?)</(?:script|style)\s*>$", 1)
        tag = F.when(t.rlike("(?i)^<(script|style)\\b.*>"), "").when(t.rlike("^<[!?]"), "!").otherwise(F.lower(F.regexp_extract(t, "^<(/?[A-Za-z][^\\s/>]*)", 1)))
        text = F.when(t.rlike("(?is)^<(script|style)\\b.*</(script|style)\\s*>$"), block).when(tag == "", unescaped(t)).otherwise("")
        return F.struct(tag.alias("tag"), text.alias("text"), t.alias("raw"))

    return F.transform(raw, token)


def html_text(html: Column) -> Column:
    """Every text of a page on a line of its own, a further line break at LINE_TAGS, at most one blank line."""
    line = lambda t: F.when(t["tag"].isin(LINE_TAGS), "\n").when(t["tag"] == "", F.nullif(trimmed(F.regexp_replace(t["text"], f"{SPACE}+", " ")), F.lit("")))
    parts = F.filter(F.transform(page_tokens(html), line), lambda p: p.isNotNull())
    return trimmed(F.regexp_replace(F.array_join(parts, "\n"), "\n{3,}", "\n\n"))


def links(html: Column, base: Column) -> Column:
    """An array of (url, text): every anchor's address, resolved against the page's own, and the text inside."""
    tokens = F.filter(page_tokens(html), lambda t: (t["tag"] == "") | t["tag"].isin("a", "/a"))
    href = lambda t: F.when(t["raw"].rlike(r"(?i)[\s\"'/]href\s*="), unescaped(F.concat(*(F.regexp_extract(t["raw"], r"""(?i)[\s"'/]href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))""", k) for k in (1, 2, 3)))))
    start = F.struct(F.lit(None).cast("string").alias("href"), F.array().cast("array<string>").alias("texts"), F.array().cast("array<struct<url:string,text:string>>").alias("found"))

    def step(state: Column, t: Column) -> Column:
        opens, closes = t["tag"] == "a", (t["tag"] == "/a") & state["href"].isNotNull()
        part = trimmed(t["text"])
        said = F.regexp_replace(F.array_join(state["texts"], " "), f"{SPACE}+", " ")
        return F.struct(
            F.when(opens, href(t)).when(closes, None).otherwise(state["href"]).alias("href"),
            F.when(opens | closes, F.array().cast("array<string>")).when((t["tag"] == "") & state["href"].isNotNull() & (part != ""), F.array_append(state["texts"], part)).otherwise(state["texts"]).alias("texts"),
            F.when(closes, F.array_append(state["found"], F.struct(state["href"].alias("url"), said.alias("text")))).otherwise(state["found"]).alias("found"),
        )

    found = F.filter(F.aggregate(tokens, start, step)["found"], lambda x: x["url"] != "")
    return F.transform(found, lambda x: F.struct(resolved(F.coalesce(base, F.lit("")), x["url"]).alias("url"), x["text"].alias("text")))
