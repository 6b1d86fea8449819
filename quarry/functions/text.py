"""Column functions for text: Python-compatible strip, the cleaning steps,
and Python-``json.dumps``-compatible quoting of strings and string lists.

All of these are native Spark expressions (whole-stage codegen, no Python).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's behaviour) -------------------
# Characters removed by Python's str.strip() with no argument (str.isspace()).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Cleaning patterns of the corpus preparation step, applied in this order.
CONTROL_CHARS_RE = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
SPACE_RUN_RE = r"[ \t]+"
NEWLINE_RUN_RE = r"\n{3,}"
HTML_TAG_RE = r"<[^>]+>"
# ---------------------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: Spark's plain ``trim`` only removes U+0020."""
    return F.trim(col_(c), F.lit(PY_WHITESPACE))


def remove_control_chars(c) -> Column:
    return F.regexp_replace(col_(c), CONTROL_CHARS_RE, "")


def remove_html_tags(c) -> Column:
    return F.regexp_replace(col_(c), HTML_TAG_RE, "")


def compress_whitespace(c) -> Column:
    return F.regexp_replace(F.regexp_replace(col_(c), SPACE_RUN_RE, " "), NEWLINE_RUN_RE, "\n\n")


def replace_literals(c, rules) -> Column:
    """Apply ``(old, new)`` literal replacements in order (a fold of ``replace``)."""
    out = col_(c)
    for old, new in rules:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def parse_replacement_rules(raw_rules) -> list[tuple[str, str]]:
    """Driver-side parse of ``old=new`` options; RHS is unicode-escape decoded."""
    import codecs

    rules = []
    for raw in raw_rules:
        if "=" not in raw:
            raise ValueError(f"Invalid replacement rule {raw!r}; expected old=new")
        old, new = raw.split("=", 1)
        rules.append((old, codecs.decode(new, "unicode_escape")))
    return rules


#: What JSON escapes inside a string.
JSON_ESCAPED_RE = r'["\\\x00-\x1f]'


def json_quote(c) -> Column:
    """``json.dumps(s, ensure_ascii=False)`` of one string: to_json of a
    one-element array without its brackets; a string with nothing to escape is
    quoted as it is, which is much cheaper."""
    j = F.to_json(F.array(col_(c)))
    plain = F.concat(F.lit('"'), col_(c), F.lit('"'))
    return F.when(~col_(c).rlike(JSON_ESCAPED_RE), plain).otherwise(F.substring(j, F.lit(2), F.length(j) - 2))


def json_string_list(c) -> Column:
    """``json.dumps(list_of_str, ensure_ascii=False)``: ``["a", "b"]`` with a space
    after each comma (Spark's ``to_json`` is compact, so it cannot be used as is)."""
    return F.concat(F.lit("["), F.array_join(F.transform(col_(c), json_quote), ", "), F.lit("]"))
