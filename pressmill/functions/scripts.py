"""Texts in objects that a page's scripts assign, found by path, as column expressions over VARIANT; no task runs Python for them."""

import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rx import let, strip

_SCRIPT = r"(?is)<script\b[^>]*>(.*?)</script\s*>"


def unescaped(text: Column) -> Column:
    """Character references as characters: decimal, hexadecimal and the 252 names of HTML 4; others stay."""
    names = F.create_map(*(F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))))

    def made(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"\A&(#?\w+);\z", 1)
        number = F.coalesce(F.conv(F.nullif(F.regexp_extract(name, r"\A#[xX]([0-9a-fA-F]{1,6})\z", 1), F.lit("")), 16, 10), F.nullif(F.regexp_extract(name, r"\A#(\d{1,7})\z", 1), F.lit("")))
        code = number.cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(name == "", piece).otherwise(F.coalesce(F.when(valid, character), F.try_element_at(names, name), piece))

    pieces = F.regexp_extract_all(text, F.lit(r"(?s)&#?\w+;|[^&]+|&"), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, made), "")).otherwise(text)


def tagless(html: Column) -> Column:
    """The strings between tags, stripped and joined by one space; scripts and styles hold none."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|template)\b.*?(?:</\1\s*>|\z)", "\u0001")
    strings = F.transform(F.split(bare, "<[a-zA-Z/!?][^>]*>|\u0001"), lambda s: strip(unescaped(s)))
    return F.array_join(F.filter(strings, lambda s: s != ""), " ")


def json_path(keys: str) -> str:
    """a.b[2].c as a JSON path."""
    out = "$"
    for part in keys.split("."):
        found = re.fullmatch(r"([^\[\]'\"]+)((?:\[\d+\])*)", part)
        if not found:
            raise ValueError(f"path not understood: {keys}")
        out += f"['{found[1]}']{found[2]}"
    return out


def assigned_objects(html: Column, variable: str) -> Column:
    """Object literals that scripts assign to a variable: of each script those of `var`, of `window.` and of any assignment, in this order."""
    name = re.escape(variable)
    forms = [rf"(?s)var\s+{name}\s*=\s*(\{{.*?\}});", rf"(?s)window\.{name}\s*=\s*(\{{.*?\}});", rf"(?s){name}\s*=\s*(\{{.*?\}});"]
    scripts = F.regexp_extract_all(html, F.lit(_SCRIPT), F.lit(1))
    found = F.flatten(F.transform(scripts, lambda s: F.array(*(F.regexp_extract(s, form, 1) for form in forms))))
    return F.filter(found, lambda x: x != "")


def script_text(html: Column, path: str) -> Column:
    """The text at variable.key.key (or key[n]) in the first object that has one there, without markup; empty if there is none.

    Objects that are no JSON, missing steps and values that are no strings count as nothing, as does a null page.
    """
    variable, _, keys = path.partition(".")
    if not keys:
        raise ValueError("a path names a variable and a key")

    def value(source: Column) -> Column:
        # as the only item of a list, since what follows an object is otherwise left unread
        whole = F.try_parse_json(F.concat(F.lit("["), source, F.lit("]")))
        got = F.try_variant_get(whole, "$[0]" + json_path(keys)[1:], "variant")
        return F.when((F.schema_of_variant(got) == "STRING") & F.try_variant_get(whole, "$[1]", "variant").isNull(), got.cast("string"))

    texts = F.filter(F.transform(assigned_objects(html, variable), value), lambda t: t.isNotNull() & (t != ""))
    # bound once: unescaped names its text three times, and each time the page would be searched anew
    return F.coalesce(let(F.get(texts, F.lit(0)), lambda t: tagless(unescaped(t))), F.lit(""))
