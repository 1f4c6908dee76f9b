"""Column helpers shared by the operators. All JVM-side built-ins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, SparkSession, functions as F

from pairforge.fixed_values import WHITESPACE

LINE_BREAK = r"\R|[\x1c-\x1e]"


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Keep a large expression for the life of the application instead of building it per query.

    For functions of plain values only; a column belongs to one running application.
    """
    kept: dict[tuple, Column] = {}

    @wraps(build)
    def get(*args: object) -> Column:
        app = SparkSession.active().sparkContext.applicationId
        if (app, *args) not in kept:
            for old in [key for key in kept if key[0] != app]:
                del kept[old]
            kept[(app, *args)] = build(*args)
        return kept[(app, *args)]

    return get


def strip(text: Column) -> Column:
    """Trim every Unicode whitespace character, not just spaces, in linear time."""
    return F.btrim(text, F.lit(WHITESPACE))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    A plain column that is referenced once inside a lambda may be inlined into
    it by the optimizer and then runs per element; a lambda variable cannot.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lines(text: Column) -> Column:
    return F.split(text, LINE_BREAK)


def fill(template: str, **values: Column) -> Column:
    """Fill the ``{name}`` marks of a prompt template with columns."""
    parts: list[Column] = []
    rest = template
    while rest:
        marks = [(rest.find("{" + name + "}"), name) for name in values]
        marks = [mark for mark in marks if mark[0] >= 0]
        if not marks:
            parts.append(F.lit(rest))
            break
        at, name = min(marks)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(values[name])
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)


def short_sha256(text: Column) -> Column:
    """First 16 hex digits of SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 16)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def json_text(*columns: str | Column) -> Column:
    """JSON of the given columns, null fields kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def last_key_wins() -> None:
    """Let the session's JSON parser accept repeated keys, as the usual parsers of replies do."""
    session = SparkSession.getActiveSession()
    if session is not None:
        session.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
