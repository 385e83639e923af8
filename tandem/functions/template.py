"""Alert templates: check (F8), JSON escape (F7), render over a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The names a template may use, and the two default payloads.
PLACEHOLDERS = (
    "table",
    "primary",
    "standby",
    "threshold",
    "consecutive",
    "affectedKeys",
    "reason",
    "subtask",
    "timestamp",
    "datetime",
)

DEFAULT_FAILOVER_TEMPLATE = (
    '{"alert":"lookup-failover","table":"${table}","primary":"${primary}",'
    '"standby":"${standby}","threshold":${threshold},"consecutive":${consecutive},'
    '"affectedKeys":${affectedKeys},"reason":"${reason}","subtask":"${subtask}",'
    '"timestamp":${timestamp},"datetime":"${datetime}"}'
)

DEFAULT_RECOVERY_TEMPLATE = (
    '{"alert":"lookup-recovered","table":"${table}","primary":"${primary}",'
    '"standby":"${standby}","subtask":"${subtask}",'
    '"timestamp":${timestamp},"datetime":"${datetime}"}'
)


class TemplateError(ValueError):
    """A template is blank, has an open or unknown placeholder, or is not JSON-shaped."""


def split_template(template: str) -> tuple[list[tuple[str, str]], str]:
    """``template`` as (literal before, placeholder name) pairs and the literal tail.

    A tail that still holds ``${`` is a placeholder that was never closed.
    """
    pairs = []
    rest = template
    while "${" in rest:
        literal, _, after = rest.partition("${")
        name, closed, remainder = after.partition("}")
        if not closed:
            break
        pairs.append((literal, name))
        rest = remainder
    return pairs, rest


def check_template(template: str | None) -> None:
    """Raise ``TemplateError`` unless the template can be rendered.

    Checked in this order: not blank, placeholders closed, names known, JSON shape. A missing
    brace is then reported as such and not as "no JSON".
    """
    text = (template or "").strip()
    if not text:
        raise TemplateError("alert template is blank")
    pairs, tail = split_template(text)
    if "${" in tail:
        raise TemplateError(f"placeholder is not closed: {tail[tail.index('${'):]}")
    unknown = list(dict.fromkeys(name for _, name in pairs if name not in PLACEHOLDERS))
    if unknown:
        raise TemplateError(f"unknown placeholders {unknown}; known: {list(PLACEHOLDERS)}")
    if (text[0], text[-1]) not in (("{", "}"), ("[", "]")):
        raise TemplateError(f"alert template must be JSON in {{}} or []: {text}")


# The two-letter escapes of JSON; other control characters become \\u00xx.
_SHORT_ESCAPES = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


def json_escape(text: Column) -> Column:
    """Content of a JSON string without its quotes; NULL becomes empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    full = plain
    for code in range(0x20):
        full = F.replace(full, F.lit(chr(code)), F.lit(_SHORT_ESCAPES.get(chr(code), f"\\u{code:04x}")))
    return F.when(text.rlike("[\\x00-\\x1f]"), full).otherwise(plain)


def render_template(template: str, values: dict[str, Column]) -> Column:
    """Payload column: each ``${name}`` becomes the escaped value, unknown names stay as written."""
    pairs, tail = split_template(template)
    parts = []
    for literal, name in pairs:
        parts.append(F.lit(literal))
        if name in values:
            parts.append(json_escape(values[name].cast("string")))
        else:
            parts.append(F.lit("${" + name + "}"))
    parts.append(F.lit(tail))
    return F.concat(*parts)
