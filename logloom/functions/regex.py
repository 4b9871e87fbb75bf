"""Linear-time (RE2 style) regular expressions on top of Java's ``rlike``.

Patterns are checked when the Column is built, never per row.
"""

from __future__ import annotations

import re

try:  # knows \p{..} classes, which the standard module rejects
    import regex as _checker
except ImportError:  # pragma: no cover
    _checker = re

# Constructs that need backtracking, not part of the dialect.
_BACKTRACKING = re.compile(r"\(\?(=|!|<=|<!|>)|\\[1-9]|\\k<|[*+?}]\+")
_POSIX_CLASS = re.compile(r"\[:(\w+):\]")
_POSIX_TO_JAVA = {
    "alnum": r"\p{Alnum}",
    "alpha": r"\p{Alpha}",
    "ascii": r"\p{ASCII}",
    "blank": r"\p{Blank}",
    "cntrl": r"\p{Cntrl}",
    "digit": r"\p{Digit}",
    "graph": r"\p{Graph}",
    "lower": r"\p{Lower}",
    "print": r"\p{Print}",
    "punct": r"\p{Punct}",
    "space": r"\p{Space}",
    "upper": r"\p{Upper}",
    "word": r"\w",
    "xdigit": r"\p{XDigit}",
}


def java_regex(pattern: str) -> str:
    """Translate ``pattern`` for ``rlike``; ValueError when it is not valid.

    ``$`` means end of text (Java also stops before a final newline) and only
    ``\\n`` ends a line for ``.``.
    """
    bare = re.sub(r"\\\\", "", pattern)
    outside = re.sub(r"\\.", "", re.sub(r"\[[^\]]*\]", "", bare))
    if _BACKTRACKING.search(re.sub(r"\[[^\]]*\]", "", bare)) and (
        _BACKTRACKING.search(outside) or re.search(r"\\[1-9]|\\k<", bare)
    ):
        raise ValueError(f"invalid regex {pattern!r}: look-around, back-references and possessive quantifiers are not supported")
    try:
        _checker.compile(_POSIX_CLASS.sub("a", pattern).replace(r"\z", r"\Z"))
    except _checker.error as exc:
        raise ValueError(f"invalid regex {pattern!r}: {exc}") from None

    multiline = re.search(r"\(\?[a-zA-Z]*m", pattern) is not None
    out, i, in_class = [], 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            out.append(pattern[i : i + 2])
            i += 2
            continue
        if in_class:
            posix = _POSIX_CLASS.match(pattern, i)
            if posix:
                out.append(_POSIX_TO_JAVA[posix.group(1)])
                i = posix.end()
                continue
            if ch == "]":
                in_class = False
            # Java gives '[' and '&&' a meaning inside a class
            out.append("\\" + ch if ch in "[&" else ch)
        elif ch == "[":
            in_class = True
            out.append(ch)
            lead = pattern[i + 1 : i + 2]
            if lead == "^":
                out.append(lead)
                i += 1
            if pattern[i + 1 : i + 2] == "]":  # a leading ']' is a literal
                out.append("\\]")
                i += 1
        elif ch == "$" and not multiline:
            out.append(r"\z")
        elif pattern.startswith("(?P<", i):
            out.append("(?<")
            i += 3
        else:
            out.append(ch)
        i += 1
    return "(?d)" + "".join(out)
