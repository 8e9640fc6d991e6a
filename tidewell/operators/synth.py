"""Synthetic tables from declarative specs.

A spec is a list of ``(column, kind, *arguments)``. Kinds with their arguments:

``sequence``; ``uuid``; ``unique_digits prefix count``; ``integer low high``;
``number low high scale``; ``float left right`` (digits before and after the point);
``choice values...``; ``boolean``; ``pattern text`` (``#`` is a digit);
``digits prefix low high``; ``day low high`` and ``moment low high`` (days relative to ``as_of``);
``same column``; ``days_after column low high``; ``hours_before column low high``;
``product quantity price``; ``cash_total quantity price commission``; ``word``, ``sentence words``,
and the text kinds of ``TEXT_KINDS``. A last argument ``("null", p)`` leaves a share ``p`` NULL.

Columns that refer to another column are built in a second projection.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import draws
from tidewell.functions.clock import wall_literal
from tidewell.functions.numbers import cash_total, trade_total

FIRST_NAMES = "Ada Ben Cleo Dan Eva Finn Gia Hugo Ida Jon Kim Leo Mia Nam Ola Pia Quy Rob Sue Tam".split()
LAST_NAMES = (
    "Abel Brook Cole Dinh Eder Frost Gray Hale Ito Jung Kane Lam Moss Nolan Ochs Park Reed Stone Tran "
    "Wood"
).split()
WORDS = (
    "amber bridge cedar delta ember field grove harbor island jetty kite lake meadow north orchard "
    "prairie quarry river shore timber"
).split()
CITIES = "Ashford Bayside Clearwater Dunmore Eastgate Fairview Glenwood Highbury Ironbridge Kingsport".split()
STATES = "Northland Eastmark Southport Westfield Midvale Lakeshore Highland Plainview".split()
COUNTRIES = "Vietnam Japan Germany France Brazil Canada Kenya Norway Spain Australia".split()
CURRENCIES = "USD EUR GBP JPY VND CAD AUD CHF".split()
LANGUAGES = "en es fr de vi ja pt nl".split()
JOBS = "Engineer Teacher Nurse Analyst Driver Chef Designer Clerk Farmer Plumber".split()
ZONES = "UTC Asia/Bangkok Europe/Berlin America/New_York Australia/Sydney Africa/Nairobi".split()
STREETS = "Oak Elm Pine Maple Birch Willow Cedar Aspen".split()
SUFFIXES = ["Ltd", "Inc", "Group", "Partners", "and Sons"]

DERIVED = ("same", "days_after", "hours_before", "product", "cash_total")


def _texts():
    """Text kinds: each takes a function that draws by sub-name."""
    pick = draws.choice

    def person(h):
        return F.concat(pick(h("f"), FIRST_NAMES), F.lit(" "), pick(h("l"), LAST_NAMES))

    def user(h):
        return F.concat(
            F.lower(pick(h("f"), FIRST_NAMES)), F.lower(pick(h("l"), LAST_NAMES)), draws.digits(h("d"), 4)
        )

    def street(h):
        return F.concat(
            draws.whole(h("n"), 1, 9999).cast("string"), F.lit(" "), pick(h("s"), STREETS), F.lit(" Street")
        )

    return {
        "name": person,
        "first_name": lambda h: pick(h("f"), FIRST_NAMES),
        "last_name": lambda h: pick(h("l"), LAST_NAMES),
        "user_name": user,
        "email": lambda h: F.concat(user(h), F.lit("@example.com")),
        "phone": lambda h: draws.pattern(h("p"), "###-###-####"),
        "street": street,
        "secondary": lambda h: F.concat(F.lit("Apt. "), draws.whole(h("a"), 1, 999).cast("string")),
        "city": lambda h: pick(h("c"), CITIES),
        "state": lambda h: pick(h("t"), STATES),
        "postcode": lambda h: draws.digits(h("z"), 5),
        "country": lambda h: pick(h("o"), COUNTRIES),
        "address": lambda h: F.concat_ws(
            ", ", street(h), pick(h("c"), CITIES), F.concat(pick(h("t"), STATES), F.lit(" "), draws.digits(h("z"), 5))
        ),
        "company": lambda h: F.concat(pick(h("l"), LAST_NAMES), F.lit(" "), pick(h("x"), SUFFIXES)),
        "job": lambda h: pick(h("j"), JOBS),
        "currency": lambda h: pick(h("u"), CURRENCIES),
        "language": lambda h: pick(h("g"), LANGUAGES),
        "time_zone": lambda h: pick(h("y"), ZONES),
        "iban": lambda h: F.concat(F.lit("GB"), draws.digits(h("i"), 2), F.lit("TIDE"), draws.digits(h("b"), 14)),
        "ipv4": lambda h: F.concat_ws(
            ".", *[draws.whole(h(f"q{i}"), 1 if i == 0 else 0, 254).cast("string") for i in range(4)]
        ),
        "ssn": lambda h: draws.pattern(h("s"), "###-##-####"),
        "slogan": lambda h: F.concat_ws(" ", pick(h("1"), WORDS), pick(h("2"), WORDS), pick(h("3"), WORDS)),
        "word": lambda h: pick(h("w"), WORDS),
    }


TEXT_KINDS = _texts()


def _base(name: str, kind: str, args: tuple, key: Column, seed: int, as_of: dt.datetime) -> Column:
    """The expression of a column that refers to no other column."""

    def h(part=""):
        return draws.draw(f"{name}/{part}" if part else name, key, seed)

    if kind == "sequence":
        return key
    if kind == "uuid":
        return draws.uuid_text(name, key, seed)
    if kind == "unique_digits":
        prefix, count = args
        low = 10 ** (count - 1)
        return F.concat(
            F.lit(prefix), draws.unique_number(key, low, 9 * low, 1_000_003).cast("string")
        )
    if kind == "integer":
        return draws.whole(h(), *args)
    if kind == "number":
        return draws.number(h(), *args)
    if kind == "float":
        left, right = args
        return draws.number(h(), 0, 10**left - 10**-right, right)
    if kind == "choice":
        return draws.choice(h(), args)
    if kind == "boolean":
        return F.pmod(h(), F.lit(2)) == 1
    if kind == "pattern":
        return draws.pattern(h(), *args)
    if kind == "digits":
        prefix, low, high = args
        return F.concat(F.lit(prefix), draws.whole(h(), low, high).cast("string"))
    if kind in ("day", "moment"):
        low, high = args
        start = wall_literal(as_of)
        if kind == "day":
            return F.date_add(start.cast("date"), draws.whole(h(), low, high).cast("int"))
        return F.timestamp_add("SECOND", draws.whole(h(), low * 86400, high * 86400), start)
    if kind == "sentence":
        return F.concat(
            F.concat_ws(" ", *[draws.choice(h(str(i)), WORDS) for i in range(args[0])]), F.lit(".")
        )
    if kind in TEXT_KINDS:
        return TEXT_KINDS[kind](h)
    raise ValueError(f"unknown kind {kind} of column {name}")


def _derived(name: str, kind: str, args: tuple, key: Column, seed: int) -> Column:
    """The expression of a column that refers to columns made before."""
    other = F.col(args[0])
    if kind == "same":
        return other
    if kind in ("product", "cash_total"):
        columns = [F.col(a) for a in args]
        return trade_total(*columns) if kind == "product" else cash_total(*columns)
    low, high = args[1:]
    amount = draws.whole(draws.draw(name, key, seed), low, high)
    if kind == "days_after":
        return F.timestamp_add("DAY", amount, other)
    return F.timestamp_add("HOUR", -amount, other)


def _split_null(args: tuple):
    if args and isinstance(args[-1], tuple) and args[-1][0] == "null":
        return args[:-1], args[-1][1]
    return args, None


def fill(
    ids: DataFrame, spec: list[tuple], key: str = "id", seed: int = 0, as_of: dt.datetime | None = None
) -> DataFrame:
    """The columns of a spec for every row of ``ids``; values depend on key, seed and ``as_of``."""
    as_of = as_of or dt.datetime(2025, 1, 1)
    key_column = F.col(key)

    def nullable(name, value, share):
        if share is None:
            return value.alias(name)
        return F.when(draws.unit(draws.draw(f"{name}/null", key_column, seed)) >= share, value).alias(name)

    base, levels = [], [[], []]
    made_first = set()
    for name, kind, *args in spec:
        args, share = _split_null(tuple(args))
        if kind in DERIVED:
            # A column derived from a derived one needs a further projection.
            level = 0 if all(a in made_first or isinstance(a, int) for a in args) else 1
            levels[level].append((name, kind, args, share))
        else:
            made_first.add(name)
            base.append(nullable(name, _base(name, kind, args, key_column, seed, as_of), share))
    df = ids.select(key_column.alias("_key"), *base)
    key_column = F.col("_key")
    for level in levels:
        if level:
            df = df.select(
                "*",
                *[
                    nullable(name, _derived(name, kind, args, key_column, seed), share)
                    for name, kind, args, share in level
                ],
            )
    return df.select(*[name for name, *_ in spec])


ROWS_PER_TASK = 250_000  # of narrow rows that are made wide


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Narrow rows dealt to tasks by their number, before they are made wide.

    A scan is cut by bytes, and a file of few columns holds millions of rows in one cut: its task would make them all.
    """
    rows = df.count()
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_task)))


def generate(
    spark: SparkSession,
    spec: list[tuple],
    rows: int,
    seed: int = 0,
    start: int = 1,
    as_of: dt.datetime | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A table of ``rows`` rows, ids from ``start``. Partitions change nothing but the layout."""
    ids = spark.range(start, start + rows, 1, partitions) if partitions else spark.range(start, start + rows)
    return fill(ids, spec, "id", seed, as_of)


def spec_from_document(document: dict, table: str) -> tuple[list[tuple], int]:
    """Spec and row count of one table of a parsed document.

    The document has ``tables``, each with ``table_name``, ``row_count`` and ``columns``; a column
    has ``column_name``, ``kind`` and ``args``.
    """
    for entry in document["tables"]:
        if entry["table_name"] == table:
            columns = [(c["column_name"], c["kind"], *c.get("args", [])) for c in entry["columns"]]
            return columns, entry["row_count"]
    raise KeyError(table)
