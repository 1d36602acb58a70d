"""JSON Schema checks of tool arguments, for the keywords in use.

An unknown keyword fails the check: what isn't understood isn't passed.
"""

from __future__ import annotations

import functools
import json
import re
from typing import Any

from quern.plans.codes import Refusal

_IGNORED = frozenset({"title", "description", "default", "examples", "$schema", "$id", "$comment", "format", "deprecated", "readOnly", "writeOnly"})


def _is_number(v: Any) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


_TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": _is_number,
    "integer": lambda v: _is_number(v) and float(v).is_integer(),
}


def _same(a: Any, b: Any) -> bool:
    if isinstance(a, bool) != isinstance(b, bool):
        return False
    return a == b


def _problem(schema: Any, value: Any, at: str) -> str | None:
    """The first failing keyword with its place, or None."""
    if schema is True or schema == {}:
        return None
    if not isinstance(schema, dict):
        return f"{at}:false"
    for keyword, want in schema.items():
        bad = False
        if keyword in _IGNORED:
            continue
        if keyword == "type":
            names = want if isinstance(want, list) else [want]
            bad = not any(n in _TYPES and _TYPES[n](value) for n in names)
        elif keyword == "enum":
            bad = not any(_same(value, x) for x in want)
        elif keyword == "const":
            bad = not _same(value, want)
        elif keyword in ("anyOf", "oneOf", "allOf"):
            passed = sum(_problem(s, value, at) is None for s in want)
            bad = passed < 1 if keyword == "anyOf" else passed != (1 if keyword == "oneOf" else len(want))
        elif keyword == "not":
            bad = _problem(want, value, at) is None
        elif keyword == "required":
            bad = isinstance(value, dict) and any(k not in value for k in want)
        elif keyword == "properties":
            for k, s in want.items() if isinstance(value, dict) else ():
                if k in value and (inner := _problem(s, value[k], f"{at}.{k}")):
                    return inner
        elif keyword == "additionalProperties":
            known = schema.get("properties", {})
            for k in value if isinstance(value, dict) else ():
                if k not in known and (inner := _problem(want, value[k], f"{at}.{k}")):
                    return inner
        elif keyword == "items":
            if not isinstance(want, (dict, bool)):
                return f"{at}:unknown-items"
            for n, item in enumerate(value if isinstance(value, list) else ()):
                if inner := _problem(want, item, f"{at}.{n}"):
                    return inner
        elif keyword in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
            bad = _is_number(value) and not {"minimum": value >= want, "maximum": value <= want, "exclusiveMinimum": value > want, "exclusiveMaximum": value < want}[keyword]
        elif keyword in ("minLength", "maxLength"):
            bad = isinstance(value, str) and not (len(value) >= want if keyword == "minLength" else len(value) <= want)
        elif keyword in ("minItems", "maxItems"):
            bad = isinstance(value, list) and not (len(value) >= want if keyword == "minItems" else len(value) <= want)
        elif keyword == "uniqueItems":
            bad = bool(want) and isinstance(value, list) and len({json.dumps(v, sort_keys=True) for v in value}) != len(value)
        elif keyword == "pattern":
            bad = isinstance(value, str) and not re.search(want, value)
        else:
            return f"{at}:unknown-keyword-{keyword}"
        if bad:
            return f"{at}:{keyword}"
    return None


@functools.lru_cache(maxsize=1024)
def _parsed(schema: str) -> Any:
    return json.loads(schema)


def check(schema: Any, value: Any) -> None:
    """Raises a Refusal naming the place and keyword that fails."""
    if isinstance(schema, str):
        schema = _parsed(schema)
    if problem := _problem(schema, value, "$"):
        raise Refusal(f"SCHEMA:{problem}")
