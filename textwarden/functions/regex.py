"""Python ``re`` notation to Java notation, with Python's Unicode classes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() and str.isalnum() sets, spelled out: Java's own \s, \w
# and \b differ from them (control separators, combining marks, other numbers).
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
BOUNDARY = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

_CLASSES = {
    "b": BOUNDARY,
    "d": r"\p{Nd}",
    "s": f"[{SPACE}]",
    "S": f"[^{SPACE}]",
    "w": f"[{WORD}]",
    "W": f"[^{WORD}]",
}


_ITEM = re.compile(
    r"\\(?P<escape>.)|(?P<named>\(\?P<(?P<name>\w+)>)|\(\?P=(?P<same>\w+)\)|(?P<refused>\(\?P>|\(\?\()"
    r"|(?P<set>\[\^?\]?)|(?P<rest>.)", re.DOTALL)
_IN_SET = re.compile(r"\\(?P<escape>.)|(?P<end>\])|(?P<odd>\[|&&)|(?P<rest>.)", re.DOTALL)


def java_pattern(pattern: str) -> str:
    r"""The pattern in Java notation with Python's meaning.

    ``\b \d \s \S \w \W`` are spelled out, ``\Z`` is the very end, ``.`` and ``$`` know only
    line feeds, groups may be named Python's way, and ``[``, ``&&`` and ``\b`` in a set are
    plain characters.  Patterns that Python refuses, or that only it has, are errors here.
    """
    re.compile(pattern)
    out, at = ["(?d)"], 0
    names: dict[str, str] = {}
    while at < len(pattern):
        m = _ITEM.match(pattern, at)
        at = m.end()
        if m["escape"]:
            out.append(r"\z" if m["escape"] == "Z" else _CLASSES.get(m["escape"], m[0]))
        elif m["named"]:
            out.append(f"(?<{names.setdefault(m['name'], f'g{len(names)}')}>")
        elif m["same"]:
            out.append(rf"\k<{names[m['same']]}>")
        elif m["refused"]:
            raise ValueError(f"no equivalent for {m[0]} in {pattern!r}")
        elif m["set"]:
            # A bracket right after the start is a member of the set.
            out.append(m["set"].replace("]", r"\]"))
            while (m := _IN_SET.match(pattern, at)) and not m["end"]:
                at = m.end()
                if m["escape"]:
                    inner = r"\x08" if m["escape"] == "b" else _CLASSES.get(m["escape"], m[0])
                    out.append(inner)
                else:
                    out.append("".join("\\" + c for c in m["odd"]) if m["odd"] else m[0])
            out.append("]")
            at = m.end()
        else:
            out.append(m[0])
    return "".join(out)


def literal_start(pattern: str) -> str:
    """Letters, digits, spaces and colons every match of the pattern begins with."""
    flat = pattern
    while (shorter := re.sub(r"\((?:\\.|[^()\\])*\)", "", flat)) != flat:
        flat = shorter
    if "|" in flat:
        return ""
    start = re.match(r"[\w :]*", pattern)[0]
    rest = pattern[len(start):]
    return start[:-1] if rest[:1] in ("?", "*", "{") else start


def search(text: Column, pattern: str) -> Column:
    """Python's ``re.search`` as a condition.

    A plain substring scan goes first where the pattern has a fixed start: it rules
    out nearly all texts far faster than the regex.
    """
    found = text.rlike(java_pattern(pattern))
    start = literal_start(pattern)
    return F.contains(text, F.lit(start)) & found if start else found
