"""Rule patterns are written in Python ``re`` syntax; Spark runs them on java.util.regex."""

from __future__ import annotations

import re

# Python counts the four ASCII separators as white space, the JVM does not.
_SPACE = r"\s\x1c-\x1f"
_QUOTES = {"'": r"\x27", '"': r"\x22"}
_NOT_SPACE = r"[^\s\x1c-\x1f]"


_UP_TO = re.compile(r"\{,(\d+)\}")
_GROUP_NAME = re.compile(r"\(\?P([<=])(\w+)[>)]")


def _java_name(name: str) -> str:
    """A group name that the JVM takes: letters and digits, a letter first."""
    return name if re.fullmatch("[a-wyzA-Z][a-zA-Z0-9]*", name) else "x" + name.encode().hex()


def java_pattern(pattern: str, flags: str = "") -> str:
    """Spell a Python pattern so that the JVM matches the same text.

    ``U`` makes character classes and case folding Unicode-aware, ``d`` leaves newline as the
    only line end. Inside a class the JVM gives ``[`` and ``&&`` a meaning Python does not.
    Quotes are written as escapes, so that the result fits a raw SQL string.
    """
    out, i, in_class = [], 0, False
    while i < len(pattern):
        two = pattern[i : i + 2]
        ch = pattern[i]
        if ch == "\\" and len(two) == 2:
            if two == r"\s":
                out.append(_SPACE if in_class else f"[{_SPACE}]")
            elif two == r"\S" and not in_class:
                out.append(_NOT_SPACE)
            elif two == r"\Z":
                out.append(r"\z")
            elif two[1] in _QUOTES:
                out.append(_QUOTES[two[1]])
            else:
                out.append(two)
            i += 2
            continue
        if ch in _QUOTES:
            out.append(_QUOTES[ch])
        elif in_class:
            if ch == "]":
                in_class = False
                out.append(ch)
            elif ch == "[" or two == "&&":
                out.append("\\" + ch)
            else:
                out.append(ch)
        elif ch == "[":
            in_class = True
            out.append(ch)
            if pattern[i + 1 : i + 2] == "^":
                out.append("^")
                i += 1
            if pattern[i + 1 : i + 2] == "]":
                out.append(r"\]")
                i += 1
        elif named := _GROUP_NAME.match(pattern, i):
            name = _java_name(named[2])
            out.append(f"(?<{name}>" if named[1] == "<" else rf"\k<{name}>")
            i = named.end()
            continue
        elif most := _UP_TO.match(pattern, i):
            out.append(f"{{0,{most[1]}}}")
            i = most.end()
            continue
        else:
            out.append(ch)
        i += 1
    return f"(?dU{flags}){''.join(out)}"
