"""Display rules of map layers as columns: switches, steps, interpolations and feature filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def match(value: Column, cases: dict, default) -> Column:
    """The result of the case that equals the value; a case may be a tuple of values."""
    out = F.lit(default)
    for key, result in reversed(list(cases.items())):
        out = F.when(value.isin(*key) if isinstance(key, tuple) else value == key, F.lit(result)).otherwise(out)
    return out


def step(value: Column, first, stops: list[tuple[float, object]]) -> Column:
    """``first`` below the first stop, then each stop's result from the stop on; results are values or columns."""
    out = F.lit(first)
    for at, result in stops:
        out = F.when(value >= at, F.lit(result)).otherwise(out)
    return out


def interpolate(value: Column, stops: list[tuple[float, object]], base: float = 1.0) -> Column:
    """Between stops linear (base 1) or exponential; beyond them the end values, which may be columns of numbers."""
    return _between(value, [(at, F.lit(y).cast("double")) for at, y in stops], base, lambda low, high, along: low + (high - low) * along)


def interpolate_colours(value: Column, stops: list[tuple[float, Column]], base: float = 1.0) -> Column:
    """Like :func:`interpolate` for :func:`colour` columns: parts are mixed by their share of opacity, as renderers do."""

    def mixed(low: Column, high: Column, along: Column) -> Column:
        alpha = low["a"] + (high["a"] - low["a"]) * along
        part = lambda k: low[k] * low["a"] + (high[k] * high["a"] - low[k] * low["a"]) * along
        return colour(*[F.when(alpha > 0, part(k) / alpha).otherwise(0.0) for k in "rgb"], alpha)

    return _between(value, stops, base, mixed)


def _between(value: Column, stops: list[tuple[float, Column]], base: float, mixed) -> Column:
    out = stops[0][1]
    for (x0, low), (x1, high) in zip(stops, stops[1:]):
        along = (value - x0) / (x1 - x0) if base == 1.0 else (F.pow(F.lit(base), value - x0) - 1) / (base ** (x1 - x0) - 1)
        out = F.when(value >= x1, high).when(value >= x0, mixed(low, high, F.least(along, F.lit(1.0)))).otherwise(out)
    return out


def colour(red, green, blue, alpha=1.0) -> Column:
    """A colour as a struct of doubles: r, g and b from 0 to 255, a from 0 to 1."""
    return F.struct(*[F.lit(v).cast("double").alias(k) for k, v in zip("rgba", (red, green, blue, alpha))])


def colour_of(text: str | Column) -> Column:
    """The colour that ``#rgb``, ``#rrggbb``, ``rgb(...)`` or ``rgba(...)`` texts name, null for others."""
    text = F.lower(F.trim(F.lit(text)))
    digits = F.regexp_extract(text, "^#([0-9a-f]{6}|[0-9a-f]{3})$", 1)
    digits = F.when(F.length(digits) == 3, F.regexp_replace(digits, "(.)", "$1$1")).otherwise(digits)
    numbers = F.transform(F.split(F.regexp_extract(text, r"^rgba?\(([0-9., ]+)\)$", 1), ","), lambda n: F.trim(n).try_cast("double"))
    from_hex = colour(*[F.conv(F.substring(digits, at, 2), 16, 10) for at in (1, 3, 5)])
    from_numbers = colour(*[F.get(numbers, F.lit(k)) for k in range(3)], F.coalesce(F.get(numbers, F.lit(3)), F.lit(1.0)))
    plain = F.size(numbers).isin(3, 4) & ~F.exists(numbers, lambda n: n.isNull())
    return F.when(F.length(digits) == 6, from_hex).when(plain, from_numbers)


def colour_text(value: Column) -> Column:
    """A colour as ``rgba(r,g,b,a)``, its parts rounded to whole numbers and its opacity to three places."""
    whole = [F.round(value[k]).cast("int") for k in "rgb"]
    return F.when(value.isNotNull(), F.concat(F.lit("rgba("), F.concat_ws(",", *whole, F.format_string("%.3f", value["a"])), F.lit(")")))


def supported_script(text: Column) -> Column:
    """Whether a text can be drawn one character after another: no right-to-left script and none that needs shaping; false for a missing text."""
    return F.coalesce(~text.rlike(f"[{_SHAPED}]"), F.lit(False))


#: Blocks of right-to-left scripts, and of scripts whose letters combine (Indic, Tibetan, Burmese, Khmer).
_SHAPED = "\u0590-\u08FF\uFB50-\uFDFF\uFE70-\uFEFF" + "\u0900-\u0DFF\u0F00-\u109F\u1780-\u17FF"


def expression(rule, zoom: float | None = None, geometry_type: Column | None = None) -> Column:
    """A display expression, nested lists such as ``["match", ["get", "kind"], ["a", "b"], 1, 0]``, as a column.

    ``["get", name]`` is a column and other values are literals. Conditions are never null:
    comparing a missing value to a literal is false, ``!=`` true. ``format`` joins its texts
    and passes over its style maps; missing texts are empty. ``zoom`` and ``geometry_type`` are what the
    expressions of these names stand for.

    Results have one type. Where any result of an expression is a colour (``rgb``, ``rgba``, ``to-color``, or texts
    that are interpolated), all are :func:`colour` structs, and texts among them are read as colours. A map
    ``{"stops": [[7, 1], [10, 2]], "base": 1, "property": name}`` interpolates numbers and colours
    and steps between other values, along the property or, without one, the zoom. Lists that start with no
    operator, such as fonts and offsets, are arrays.
    """
    return _column(rule, zoom, geometry_type, _is_colour(rule))


def _is_colour(rule) -> bool:
    if isinstance(rule, dict):
        results = [y for _, y in rule.get("stops", [])]
        return any(map(_is_colour, results)) or bool(results) and all(map(_is_colour_text, results))
    if not isinstance(rule, list) or not rule:
        return False
    name, rest = rule[0], rule[1:]
    if name == "interpolate":
        return any(_is_colour(y) or isinstance(y, str) for y in rest[3::2])
    return name in _COLOURS or any(map(_is_colour, _results(name, rest)))


def _is_colour_text(value) -> bool:
    return isinstance(value, str) and value.strip().lower().startswith(("#", "rgb(", "rgba("))


def _results(name: str, rest: list) -> list:
    """The operands of a choice that can become its result."""
    kinds = {"coalesce": rest, "case": [*rest[1:-1:2], *rest[-1:]], "match": [*rest[2:-1:2], *rest[-1:]], "step": [*rest[1:2], *rest[3::2]]}
    return kinds.get(name, []) if isinstance(name, str) else []


def _column(rule, zoom: float | None, geometry_type: Column | None, coloured: bool = False) -> Column:
    def sub(r, coloured: bool = False) -> Column:
        return _column(r, zoom, geometry_type, coloured or _is_colour(r))

    def result(r) -> Column:
        return sub(r, coloured)

    def interpolated(value: Column, stops: list, base: float) -> Column:
        return (interpolate_colours if coloured else interpolate)(value, [(at, result(y)) for at, y in stops], base)

    if isinstance(rule, dict):
        if "stops" not in rule:
            raise ValueError("a map without stops is no display expression")
        stops, base = [tuple(s) for s in rule["stops"]], float(rule.get("base", 1.0))
        value = F.col(f"`{rule['property']}`") if "property" in rule else sub(["zoom"])
        if coloured or all(isinstance(y, (int, float)) and not isinstance(y, bool) for _, y in stops):
            return interpolated(value, stops, base)
        return step(value, result(stops[0][1]), [(at, result(y)) for at, y in stops[1:]])
    if not isinstance(rule, list):
        return colour_of(rule) if coloured and isinstance(rule, str) else F.lit(rule)
    name, *rest = rule if rule else [None]
    if not isinstance(name, str) or all(isinstance(r, str) for r in rule) and name not in _WITHOUT_OPERANDS | _OF_TEXTS:
        return F.array(*map(F.lit, rule))
    if name == "to-color":
        return sub(rest[0], True)
    if name in _COLOURS:
        return colour(*map(sub, rest))
    if name == "is-supported-script":
        return supported_script(sub(rest[0]))
    if name == "get":
        return colour_of(F.col(f"`{rest[0]}`")) if coloured else F.col(f"`{rest[0]}`")
    if name == "literal":
        return F.array(*map(F.lit, rest[0])) if isinstance(rest[0], list) else F.lit(rest[0])
    if name == "zoom":
        if zoom is None:
            raise ValueError("the expression depends on the zoom, and none is given")
        return F.lit(float(zoom))
    if name == "geometry-type":
        if geometry_type is None:
            raise ValueError("the expression depends on the geometry type, and none is given")
        return geometry_type
    if name == "has":
        return F.col(f"`{rest[0]}`").isNotNull()
    if name == "!":
        return ~sub(rest[0])
    if name in ("all", "any"):
        joined = (lambda a, b: a & b) if name == "all" else (lambda a, b: a | b)
        return reduce(joined, map(sub, rest), F.lit(name == "all"))
    if name == "in":
        return F.coalesce(F.array_contains(sub(rest[1]), sub(rest[0])), F.lit(False))
    if name in ("==", "!="):
        same = sub(rest[0]).eqNullSafe(sub(rest[1]))
        return same if name == "==" else ~same
    if name in _COMPARE:
        return F.coalesce(getattr(sub(rest[0]), _COMPARE[name])(sub(rest[1])), F.lit(False))
    if name in _ARITHMETIC:
        return reduce(_ARITHMETIC[name], map(sub, rest))
    if name == "coalesce":
        return F.coalesce(*map(result, rest))
    if name in ("format", "concat"):
        return F.concat(*[F.coalesce(sub(r).cast("string"), F.lit("")) for r in rest if not isinstance(r, dict)])
    if name == "case":
        out = result(rest[-1])
        for condition, then in reversed(list(zip(rest[:-1:2], rest[1:-1:2]))):
            out = F.when(sub(condition), result(then)).otherwise(out)
        return out
    if name == "match":
        value, out = sub(rest[0]), result(rest[-1])
        for case, then in reversed(list(zip(rest[1:-1:2], rest[2:-1:2]))):
            out = F.when(value.isin(*case) if isinstance(case, list) else value == case, result(then)).otherwise(out)
        return out
    if name == "step":
        return step(sub(rest[0]), result(rest[1]), [(at, result(r)) for at, r in zip(rest[2::2], rest[3::2])])
    if name == "interpolate":
        (kind, *base), value, *stops = rest
        return interpolated(sub(value), list(zip(stops[::2], stops[1::2])), float(base[0]) if kind == "exponential" else 1.0)
    raise ValueError(f"unknown display expression {name!r}")


_COLOURS = {"rgb", "rgba", "to-color"}
_WITHOUT_OPERANDS = {"zoom", "geometry-type", "all", "any"}
_OF_TEXTS = {"get", "has", "literal", "==", "!=", "coalesce", "format", "concat", "to-color", "is-supported-script"}
_ARITHMETIC = {"+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b, "/": lambda a, b: a / b}
_COMPARE = {"==": "__eq__", "!=": "__ne__", "<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__"}


def feature_filter(rule: list, zoom: float | None = None, geometry_type: Column | None = None) -> Column:
    """A filter such as ``["all", [">=", "size", 3], ["in", "kind", "a", "b"]]`` as a condition that is never null.

    A comparison whose first operand is a list, such as ``["==", ["get", "kind"], "a"]``, is an :func:`expression`.
    """
    name, *rest = rule
    if name in ("all", "any"):
        parts = [feature_filter(r, zoom, geometry_type) for r in rest]
        joined = (lambda a, b: a & b) if name == "all" else (lambda a, b: a | b)
        return reduce(joined, parts, F.lit(name == "all")) if parts else F.lit(name == "all")
    if name == "!":
        return ~feature_filter(rest[0], zoom, geometry_type)
    if rest and isinstance(rest[0], list):
        return expression(rule, zoom, geometry_type)
    if name in ("has", "!has"):
        there = F.col(rest[0]).isNotNull()
        return there if name == "has" else ~there
    if name in ("in", "!in"):
        held = F.coalesce(F.col(rest[0]).isin(*rest[1:]), F.lit(False))
        return held if name == "in" else ~held
    if name == "!=":
        return F.coalesce(F.col(rest[0]) != rest[1], F.lit(True))
    return F.coalesce(getattr(F.col(rest[0]), _COMPARE[name])(rest[1]), F.lit(False))


def visible(zoom: float, least: Column, most: Column | None = None) -> Column:
    """Whether features are drawn at a zoom: from their least zoom on, up to but without ``most``; missing limits do not hold back."""
    z = F.lit(float(zoom))
    return F.coalesce(z >= least, F.lit(True)) & (F.coalesce(z < most, F.lit(True)) if most is not None else F.lit(True))
