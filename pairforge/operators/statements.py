"""Which tables and columns a SQL statement names, as column expressions.

A statement becomes an array of tokens; scopes are position intervals over that
array, so "enclosing scopes of this name" is a filter on intervals. Everything
is decided inside one row against the catalog of that row's database: no token
is ever shuffled, and no statement is larger than its own row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from pairforge.functions.text import bind

# Comments, quoted text, names, numbers, two-character operators, anything else.
# No name holds SEPARATOR, so a joined shape splits back into the same tokens.
SEPARATOR = "\1"
TOKEN = (
    r"--[^\n]*|/\*[\s\S]*?\*/|'[^']*'|\"[^\"\x01]*\"|`[^`\x01]*`|\[[^\]\x01]*\]"
    r"|[\p{L}_][\p{L}\p{N}_$]*|[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
    r"|<=|>=|<>|!=|==|\|\||[^\s\x01]"
)

# Words that are never a table, alias or column name.
KEYWORDS = """
    select from where group by having order limit offset union intersect except all distinct
    as on using join inner left right full outer cross natural and or not in is null like glob
    between exists case when then else end asc desc with recursive materialized values cast
    collate escape over partition window
""".split()

SET_OPERATORS = ["union", "intersect", "except"]
CLAUSES = ["select", "from", "where", "group", "having", "order", "limit", "join", "on", "using"]
FROM_LIST = ["from", "join", ","]
LITERAL = "?"


def raw_tokens(sql: Column) -> Column:
    """Ordered tokens of a statement, comments removed."""
    found = F.regexp_extract_all(sql, F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda t: ~(t.startswith("--") | t.startswith("/*")))


def token_kind(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    return (
        F.when(first == "'", F.when(F.length(token) > 1, "string").otherwise("punct"))
        .when(first.isin('"', "`", "[") & (F.length(token) > 1), "quoted")
        .when(first.between("0", "9"), "number")
        .when(token.rlike(r"^[\p{L}_]"), "word")
        .otherwise("punct")
    )


def statement_shape(tokens: Column) -> Column:
    """Tokens of the first statement, lower case, literals blanked.

    Two statements of equal shape use the same tables and columns.
    """
    semicolon = F.array_position(tokens, ";")
    first_statement = F.when(
        semicolon > 0, F.slice(tokens, F.lit(1), (semicolon - 1).cast("int"))
    ).otherwise(tokens)
    return F.transform(
        first_statement,
        lambda t: F.when(
            t.startswith("'") & (F.length(t) > 1) | F.substring(t, 1, 1).between("0", "9"),
            F.lit(LITERAL),
        ).otherwise(F.lower(t)),
    )


def shape_text(sql: Column) -> Column:
    """The shape of a statement as one string."""
    return F.array_join(statement_shape(raw_tokens(sql)), SEPARATOR)


def shape_tokens(text: Column) -> Column:
    return F.split(text, SEPARATOR)


def _name(token: Column, before: Column) -> Column:
    """The identifier a token spells, or null; the common cases are decided first."""
    first = F.substring(token, 1, 1)
    quoted = F.when(F.length(token) > 1, F.substring(token, F.lit(2), F.length(token) - 2))
    return (
        F.when(token.isin(LITERAL, "(", ")", ",", ".", "=", "*", "<", ">"), None)
        .when(token.isin(*KEYWORDS) & ~before.eqNullSafe(F.lit(".")), None)
        .when(first.isin('"', "`", "["), quoted)
        .when(token.rlike(r"^[\p{L}_]"), token)
    )


def _last(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def _inside(pair: Column, at: Column) -> Column:
    return (pair["open"] < at) & (at < pair["close"])


def _parens(toks: Column) -> Column:
    """Matched parentheses, and whether any is left over."""
    start = F.struct(
        F.array().cast("array<int>").alias("stack"),
        F.array().cast("array<struct<open:int,close:int>>").alias("pairs"),
        F.lit(False).alias("bad"),
    )

    def step(acc: Column, tok: Column) -> Column:
        stack, pairs = acc["stack"], acc["pairs"]
        opened = F.struct(
            F.concat(F.array(tok["i"]), stack).alias("stack"),
            pairs.alias("pairs"),
            acc["bad"].alias("bad"),
        )
        closed = F.struct(
            F.slice(stack, F.lit(2), F.greatest(F.size(stack), F.lit(1))).alias("stack"),
            F.when(
                F.size(stack) > 0,
                F.concat(
                    pairs,
                    F.array(
                        F.struct(F.get(stack, F.lit(0)).alias("open"), tok["i"].alias("close"))
                    ),
                ),
            )
            .otherwise(pairs)
            .alias("pairs"),
            (acc["bad"] | (F.size(stack) == 0)).alias("bad"),
        )
        return F.when(tok["t"] == "(", opened).otherwise(closed)

    return F.aggregate(F.filter(toks, lambda k: k["t"].isin("(", ")")), start, step)


def _starts_query(token: Column) -> Column:
    return F.coalesce(token.isin("select", "with"), F.lit(False))


def _regions(shape: Column, toks: Column, pairs: Column) -> Column:
    """SELECT scopes as nested position intervals, one per set-operation branch."""
    whole = F.array(F.struct(F.lit(-1).alias("open"), F.size(shape).alias("close")))
    scopes = F.concat(
        whole, F.filter(pairs, lambda p: _starts_query(F.get(shape, p["open"] + 1)))
    )

    def split(scopes: Column) -> Column:
        cuts = F.transform(
            F.filter(toks, lambda k: k["t"].isin(*SET_OPERATORS)),
            lambda k: F.struct(
                k["i"].alias("i"),
                F.array_max(
                    F.transform(
                        F.filter(scopes, lambda s: _inside(s, k["i"])), lambda s: s["open"]
                    )
                ).alias("open"),
            ),
        )

        def branches(scope: Column, cuts: Column) -> Column:
            own = F.filter(cuts, lambda c: c["open"] == scope["open"])
            bounds = F.concat(
                F.array(scope["open"]), F.transform(own, lambda c: c["i"]), F.array(scope["close"])
            )
            return bind(
                bounds,
                lambda b: F.transform(
                    F.sequence(F.lit(0), F.size(b) - 2),
                    lambda j: F.struct(
                        F.get(b, j).alias("start"),
                        F.get(b, j + 1).alias("end"),
                        scope["open"].alias("open"),
                        scope["close"].alias("close"),
                    ),
                ),
            )

        return bind(cuts, lambda c: F.flatten(F.transform(scopes, lambda s: branches(s, c))))

    return bind(scopes, split)


def _innermost_paren(pairs: Column, at: Column) -> Column:
    return F.coalesce(
        F.array_max(F.transform(F.filter(pairs, lambda p: _inside(p, at)), lambda p: p["open"])),
        F.lit(-1),
    )


def _place(toks: Column, regions: Column) -> Column:
    """Tokens with the interval of their own scope."""
    def place(k: Column) -> Column:
        home = F.array_max(
            F.filter(regions, lambda r: (r["start"] < k["i"]) & (k["i"] < r["end"]))
        )
        return bind(
            home,
            lambda r: F.struct(
                k["i"].alias("i"), k["t"].alias("t"), k["p"].alias("p"), k["x"].alias("x"),
                k["n"].alias("n"), r["start"].alias("start"), r["end"].alias("end"),
                r["open"].alias("open"), r["close"].alias("close"),
            ),
        )

    return F.transform(toks, place)


def _clause_marks(toks: Column, pairs: Column, shape: Column) -> Column:
    """Clause words per scope; a comma that continues a FROM list counts as one."""
    words = F.filter(
        toks,
        lambda k: k["t"].isin(*CLAUSES)
        & ~k["p"].eqNullSafe(F.lit("."))
        & ~((k["t"] == "from") & k["p"].eqNullSafe(F.lit("distinct")))
        & (
            k["t"].isin("join", "on", "using")
            | (_innermost_paren(pairs, k["i"]) == k["open"])
        ),
    )

    def with_commas(words: Column) -> Column:
        def separates(k: Column) -> Column:
            clause = _last(
                F.filter(words, lambda w: (w["start"] == k["start"]) & (w["i"] < k["i"]))
            )["t"]
            paren = _innermost_paren(pairs, k["i"])
            top = paren == k["open"]
            grouped = F.get(shape, paren - 1).isin("from", "join", ",", "(")
            return F.when(clause.isin("from", "join"), top | F.coalesce(grouped, F.lit(False))).when(
                clause.isin("on", "using"), top
            ).otherwise(F.lit(False))

        commas = F.filter(toks, lambda k: k["t"] == ",")
        return F.concat(words, F.filter(commas, separates))

    return F.array_sort(bind(words, with_commas))


def _with_clause(toks: Column, marks: Column) -> Column:
    """Tokens with the clause they stand in, for those that can name or select something."""
    def clause(k: Column) -> Column:
        before = F.filter(marks, lambda m: (m["start"] == k["start"]) & (m["i"] < k["i"]))
        asks = k["n"].isNotNull() | (k["t"] == "*") | ((k["t"] == "(") & _starts_query(k["x"]))
        return k.withField("c", F.when(asks, _last(before)["t"]))

    return F.transform(toks, clause)


def _common_tables(shape: Column, toks: Column, pairs: Column, regions: Column) -> Column:
    """CTE names with the interval of their body and of the scope that sees them."""
    queries = F.filter(pairs, lambda p: _starts_query(F.get(shape, p["open"] + 1)))

    def cte(p: Column) -> Column:
        back = F.when(F.get(shape, p["open"] - 1) != "materialized", 1).when(
            F.get(shape, p["open"] - 2) == "not", 3
        ).otherwise(2)
        as_at = p["open"] - back
        list_open = F.get(
            F.transform(F.filter(pairs, lambda q: q["close"] == as_at - 1), lambda q: q["open"]),
            F.lit(0),
        )
        name = F.coalesce(F.get(toks, as_at - 1)["n"], F.get(toks, list_open - 1)["n"])
        owner = F.array_max(F.filter(regions, lambda r: _inside(r, p["open"])))
        return F.struct(
            F.when(F.get(shape, as_at) == "as", name).alias("name"),
            owner["open"].alias("low"),
            owner["close"].alias("high"),
            p["open"].alias("open"),
            p["close"].alias("close"),
        )

    return F.filter(F.transform(queries, cte), lambda c: c["name"].isNotNull())


def _sources(
    shape: Column, toks: Column, pairs: Column, ctes: Column, marks: Column, tables: Column
) -> Column:
    """FROM items: alias, catalog table or null, and the body of a subquery."""
    comma_at = F.transform(F.filter(marks, lambda m: m["t"] == ","), lambda m: m["i"])

    def starts(k: Column, commas: Column) -> Column:
        grouped = (k["p"] == "(") & F.coalesce(
            F.get(shape, k["i"] - 2).isin("from", "join", ",", "("), F.lit(False)
        )
        follows = (
            k["p"].isin("from", "join")
            | ((k["p"] == ",") & F.array_contains(commas, k["i"] - 1))
            | grouped
        )
        item = k["n"].isNotNull() | ((k["t"] == "(") & _starts_query(k["x"]))
        return F.coalesce(follows & item & k["c"].isin(*FROM_LIST), F.lit(False))

    def describe(k: Column) -> Column:
        derived = k["t"] == "("
        close = F.get(
            F.transform(F.filter(pairs, lambda p: p["open"] == k["i"]), lambda p: p["close"]),
            F.lit(0),
        )
        base = F.when(derived, close).when(k["x"] == ".", k["i"] + 2).otherwise(k["i"])

        def finish(base: Column) -> Column:
            name = F.when(~derived, F.get(toks, base)["n"])
            after = F.get(toks, base + 1)
            alias = F.when(after["t"] == "as", F.get(toks, base + 2)["n"]).when(
                after["n"].isNotNull(), after["n"]
            ).otherwise(name)
            plain = F.when(~F.coalesce(after["t"] == "(", F.lit(False)), name)
            hidden_by = _last(
                F.filter(
                    ctes,
                    lambda c: (c["name"] == plain)
                    & (c["low"] < k["i"])
                    & (k["i"] < c["high"])
                    & (
                        (k["i"] > c["close"])
                        | (F.array_contains(shape, "recursive") & (k["i"] > c["open"]))
                    ),
                )
            )
            table = F.when(
                hidden_by.isNull(), _last(F.filter(tables, lambda t: t["name"] == plain))
            )
            return F.struct(
                k["start"].alias("start"), k["end"].alias("end"), k["i"].alias("i"),
                alias.alias("alias"), table["name"].alias("table_name"),
                table["columns"].alias("columns"),
                F.when(derived, k["i"]).otherwise(hidden_by["open"]).alias("body_open"),
                F.when(derived, close).otherwise(hidden_by["close"]).alias("body_close"),
            )

        return bind(base, finish)

    return bind(
        comma_at, lambda commas: F.transform(F.filter(toks, lambda k: starts(k, commas)), describe)
    )


def _use(table: Column, column: Column) -> Column:
    return F.struct(table.alias("table_name"), column.alias("column_name"))


def _uses_all(sources: Column) -> Column:
    return F.flatten(
        F.transform(
            F.filter(sources, lambda s: s["table_name"].isNotNull()),
            lambda s: F.transform(s["columns"], lambda c: _use(s["table_name"], c)),
        )
    )


def _sees(source: Column, at: Column) -> Column:
    return (source["start"] < at) & (at < source["end"])


def _nearest(sources: Column, alias: Column, at: Column) -> Column:
    """The source an alias means at a position: nearest enclosing scope wins."""
    return F.array_max(F.filter(sources, lambda s: (s["alias"] == alias) & _sees(s, at)))


def _qualified(toks: Column, sources: Column) -> Column:
    refs = F.filter(
        toks,
        lambda k: (k["p"] == ".")
        & k["n"].isNotNull()
        & ~k["x"].eqNullSafe(F.lit("."))
        & k["c"].isin(*CLAUSES)
        & ~k["c"].isin(*FROM_LIST),
    )

    def resolve(k: Column) -> Column:
        return bind(
            _nearest(sources, F.get(toks, k["i"] - 2)["n"], k["i"]),
            lambda s: F.when(F.array_contains(s["columns"], k["n"]), _use(s["table_name"], k["n"])),
        )

    return F.filter(F.transform(refs, resolve), lambda u: u.isNotNull())


def _stars(toks: Column, sources: Column) -> Column:
    stars = F.filter(
        toks,
        lambda k: (k["t"] == "*")
        & (
            k["p"].isin(".", "select", "distinct", "all")
            | ((k["p"] == ",") & (k["c"] == "select"))
        ),
    )

    def expand(k: Column) -> Column:
        named = F.array(_nearest(sources, F.get(toks, k["i"] - 2)["n"], k["i"]))
        own = F.filter(sources, lambda s: s["start"] == k["start"])
        return _uses_all(F.when(k["p"] == ".", named).otherwise(own))

    return F.flatten(F.transform(stars, expand))


def _implicit_alias(toks: Column, k: Column) -> Column:
    before = F.get(toks, k["i"] - 1)
    return (k["c"] == "select") & (
        before["n"].isNotNull() | F.coalesce(before["t"].isin(LITERAL, ")", "end"), F.lit(False))
    )


def _bare(toks: Column, pairs: Column, sources: Column) -> Column:
    aliases = F.filter(
        toks,
        lambda k: (k["c"] == "select")
        & k["n"].isNotNull()
        & ((k["p"] == "as") | _implicit_alias(toks, k))
        & (_innermost_paren(pairs, k["i"]) == k["open"]),
    )

    def is_ref(k: Column, aliases: Column) -> Column:
        return (
            k["n"].isNotNull()
            & ~F.coalesce(k["p"].isin(".", "as", "collate"), F.lit(False))
            & ~F.coalesce(k["x"].isin(".", "("), F.lit(False))
            & k["c"].isin(*CLAUSES)
            & ~k["c"].isin(*FROM_LIST)
            & ~_implicit_alias(toks, k)
            & ~(
                (k["c"] == "order")
                & F.exists(aliases, lambda a: (a["open"] == k["open"]) & (a["n"] == k["n"]))
            )
        )

    def has(source: Column, k: Column) -> Column:
        return F.coalesce(F.array_contains(source["columns"], k["n"]), F.lit(False))

    def joined(k: Column) -> Column:
        both = F.filter(
            sources, lambda s: (s["start"] == k["start"]) & (s["i"] < k["i"]) & has(s, k)
        )
        return F.transform(both, lambda s: _use(s["table_name"], k["n"]))

    def single(k: Column) -> Column:
        found = F.filter(sources, lambda s: _sees(s, k["i"]) & has(s, k))

        def decide(found: Column) -> Column:
            level = F.array_max(F.transform(found, lambda s: s["start"]))
            owners = F.array_distinct(
                F.transform(
                    F.filter(found, lambda s: s["start"] == level), lambda s: s["table_name"]
                )
            )
            # A nearer subquery or CTE that yields this name comes first.
            supplied = F.exists(
                sources,
                lambda s: s["body_open"].isNotNull()
                & _sees(s, k["i"])
                & (s["start"] > level)
                & F.exists(
                    toks,
                    lambda j: (s["body_open"] < j["i"])
                    & (j["i"] < s["body_close"])
                    & (j["n"].eqNullSafe(k["n"]) | ((j["t"] == "*") & (j["p"] != "("))),
                ),
            )
            return F.when(
                (F.size(owners) == 1) & ~supplied, F.array(_use(F.get(owners, F.lit(0)), k["n"]))
            ).otherwise(F.array().cast("array<struct<table_name:string,column_name:string>>"))

        return bind(found, decide)

    refs = bind(aliases, lambda a: F.filter(toks, lambda k: is_ref(k, a)))
    return F.flatten(
        F.transform(
            refs, lambda k: F.when(k["c"] == "using", joined(k)).otherwise(single(k))
        )
    )


def _problem(shape: Column, toks: Column, parens: Column, regions: Column, marks: Column,
             sources: Column) -> Column:
    """Why a statement is outside what this resolver reads, or null."""
    def any_of(*conditions: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])

    first = F.get(F.filter(shape, lambda t: t != "("), F.lit(0))
    stops = ["from", "where", "group", "having", "order", "limit", "join", "on", ")"]
    misplaced = F.exists(
        toks,
        lambda k: any_of(
            k["p"].isin(",", "select", "where", "on", "and", "or") & k["t"].isin(*stops),
            k["p"].isin("from", "join") & k["n"].isNull() & (k["t"] != "("),
            k["n"].isNotNull()
            & F.get(toks, k["i"] - 1)["n"].isNotNull()
            & F.get(toks, k["i"] - 2)["n"].isNotNull(),
        ),
    )
    two_selects = F.exists(
        regions,
        lambda r: F.size(
            F.filter(marks, lambda m: (m["t"] == "select") & (m["start"] == r["start"]))
        ) > 1,
    )
    return (
        F.when(~_starts_query(first), "not a query")
        .when(parens["bad"] | (F.size(parens["stack"]) > 0), "unbalanced parentheses")
        .when(F.exists(shape, lambda t: t.isin("'", '"', "`", "[", "]")), "unclosed quote")
        .when(misplaced | two_selects, "malformed clause")
        .when(
            ~F.exists(sources, lambda s: s["table_name"].isNotNull()), "no catalog table resolved"
        )
    )


def resolve_statement(shape: Column, tables: Column) -> Column:
    """Struct of everything found in one statement.

    ``shape`` comes from :func:`statement_shape`; ``tables`` is an array of
    ``struct<name, columns: array<string>>`` in lower case.
    """
    tokens = F.transform(
        shape,
        lambda t, i: F.struct(
            i.alias("i"), t.alias("t"), F.get(shape, i - 1).alias("p"),
            F.get(shape, i + 1).alias("x"), _name(t, F.get(shape, i - 1)).alias("n"),
        ),
    )

    def finish(toks, parens, regions, marks, sources):
        pairs = parens["pairs"]
        qualified, stars, bare = _qualified(toks, sources), _stars(toks, sources), _bare(toks, pairs, sources)
        found = F.struct(qualified.alias("q"), stars.alias("s"), bare.alias("b"))
        named = F.transform(
            F.filter(sources, lambda s: s["table_name"].isNotNull()),
            lambda s: _use(s["table_name"], F.lit(None).cast("string")),
        )
        return bind(
            found,
            lambda f: F.struct(
                _problem(shape, toks, parens, regions, marks, sources).alias("problem"),
                toks.alias("tokens"),
                sources.alias("sources"),
                f["q"].alias("qualified"),
                f["s"].alias("stars"),
                f["b"].alias("bare"),
                F.array_distinct(F.concat(named, f["q"], f["s"], f["b"])).alias("used"),
            ),
        )

    def from_toks(toks: Column) -> Column:
        return bind(_parens(toks), lambda parens: from_parens(toks, parens))

    def from_parens(toks, parens):
        return bind(
            _regions(shape, toks, parens["pairs"]),
            lambda regions: bind(
                _place(toks, regions), lambda placed: from_regions(placed, parens, regions)
            ),
        )

    def from_regions(placed, parens, regions):
        pairs = parens["pairs"]
        return bind(
            _clause_marks(placed, pairs, shape),
            lambda marks: bind(
                _with_clause(placed, marks),
                lambda toks: bind(
                    _common_tables(shape, toks, pairs, regions),
                    lambda ctes: bind(
                        _sources(shape, toks, pairs, ctes, marks, tables),
                        lambda sources: finish(toks, parens, regions, marks, sources),
                    ),
                ),
            ),
        )

    return bind(tokens, from_toks)
