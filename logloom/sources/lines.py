"""Log lines -> events: JSON objects are parsed and flattened, other lines stay text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.session import materialize

# Characters trimmed from both ends of a line.
BLANKS = " \t\n\x0b\f\r\x85\xa0                　"

# Strict JSON, except that text after the object is tolerated.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed exactly once per row.

    It comes out of a one-row ``inline``, which the optimizer does not fold into
    later expressions: a parse used by many of them would otherwise be repeated
    in each. Filters on other columns still reach the scan.
    """
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def json_object(line: str, first: str) -> Column:
    """VARIANT of the JSON object in column ``line``, NULL for anything else.

    ``first`` holds the result of ``try_parse_json``, which tolerates text after
    the object but not a repeated key. Only that needs another parser here, and
    keeps the last value. An object nested in the line's object that repeats a key
    has no variant form; the fields of such a line are opened as texts.
    """
    repeats = F.to_variant_object(
        _let(F.map_entries(F.from_json(line, "map<string,variant>", STRICT)), last_wins)
    )
    broken = F.startswith(line, F.lit("{")) & F.col(first).isNull()
    return F.when(broken, F.coalesce(repeats, F.to_variant_object(_opened_texts(F.col(line))))).otherwise(F.col(first))


def _braces(text: Column) -> Column:
    """An upper bound of the nesting of a JSON text."""
    return F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))


def _opened_texts(text: Column) -> Column:
    """Dotted fields of a JSON object as texts, opened level by level; the last of a repeated key wins.

    A string that is itself the text of an object is opened too.
    """

    def level(value: Column, prefix: Column | None = None) -> Column:
        pairs = F.map_entries(_let(F.map_entries(F.from_json(value, "map<string,string>", STRICT)), last_wins))
        return pairs if prefix is None else F.transform(
            pairs, lambda e: F.struct(F.concat(prefix, F.lit("."), e["key"]).alias("key"), e["value"].alias("value"))
        )

    def opened(e: Column) -> Column:
        inside = F.when(F.startswith(e["value"], F.lit("{")), level(e["value"], e["key"]))
        return F.coalesce(inside, F.array(e))

    def deeper(entries: Column, _: Column) -> Column:
        return F.flatten(F.transform(entries, opened))

    rounds = F.sequence(F.lit(1), F.greatest(_braces(text), F.lit(1)))
    return _let(F.aggregate(rounds, level(text), deeper), last_wins)


def _entries(object_map: Column, prefix: Column | None = None) -> Column:
    """Entries with their text, and the fields inside when the value is an object."""

    def with_text(e: Column) -> Column:
        key = e["key"] if prefix is None else F.concat(prefix, F.lit("."), e["key"])
        return F.struct(
            key.alias("key"), e["value"].cast("string").alias("text"), e["value"].alias("value")
        )

    def opened(e: Column) -> Column:
        inside = F.when(
            F.startswith(e["text"], F.lit("{")), e["value"].try_cast("map<string,variant>")
        )
        return F.struct(e["key"].alias("key"), e["text"].alias("value"), inside.alias("sub"))

    return F.transform(F.transform(F.map_entries(object_map), with_text), opened)


def _as_text(e: Column) -> Column:
    return F.struct(e["key"].alias("key"), e["value"].alias("value"))


def _split_level(entries: Column) -> Column:
    """Text leaves of one level, and the entries found inside its objects."""
    objects = F.filter(entries, lambda e: e["sub"].isNotNull())
    return F.struct(
        F.transform(F.filter(entries, lambda e: e["sub"].isNull()), _as_text).alias("leaves"),
        F.flatten(F.transform(objects, lambda e: _entries(e["sub"], e["key"]))).alias("open"),
    )


def flatten(json: Column, max_depth: int | None = None, depth: Column | None = None) -> Column:
    """A VARIANT object -> ``MAP<STRING, STRING>`` with dotted keys.

    Arrays and scalars are leaves (arrays as JSON text), empty objects vanish,
    explicit nulls stay as keys, a repeated key keeps the last value, and an
    object below ``max_depth``, if given, stays JSON text. Integers are exact at any size;
    other numbers are printed by Spark (``1.50`` -> ``1.5``, ``1e3`` -> ``1000.0``).
    ``depth``, an upper bound of a row's own nesting, saves empty rounds.
    """
    bound = F.greatest(_braces(json.cast("string")) if depth is None else depth, F.lit(1))
    levels = bound if max_depth is None else F.least(F.lit(max_depth), bound)

    def deeper(acc: Column, _: Column) -> Column:
        return _let(
            _split_level(acc["open"]),
            lambda level: F.struct(
                F.concat(acc["leaves"], level["leaves"]).alias("leaves"),
                level["open"].alias("open"),
            ),
        )

    def finish(acc: Column) -> Column:
        left = F.filter(acc["open"], lambda e: e["sub"].isNull() | (F.size(e["sub"]) > 0))
        return F.concat(acc["leaves"], F.transform(left, _as_text))

    top = _entries(F.try_variant_get(json, "$", "map<string,variant>"))
    if max_depth is not None and max_depth < 2:
        return _let(F.transform(top, _as_text), last_wins)
    # the first split yields level 2, every round opens one more
    first = _let(top, _split_level)
    rounds = F.slice(F.sequence(F.lit(1), levels), 2, F.greatest(levels - 2, F.lit(0)))
    return _let(F.aggregate(rounds, first, deeper, finish), last_wins)


def last_wins(entries: Column) -> Column:
    def keys(e: Column) -> Column:
        return F.transform(e, lambda x: x["key"])

    repeated = F.size(F.array_distinct(keys(entries))) < F.size(entries)
    last_only = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + F.lit(2), F.size(entries)), lambda later: later["key"] == e["key"]
        ),
    )
    return F.map_from_entries(F.when(repeated, last_only).otherwise(entries))


def _pickable(name: str) -> bool:
    """Whether a name can be read by path: few dots, and no quotes or empty parts."""
    parts = name.split(".")
    return len(parts) <= 5 and all(parts) and not set(name) & set("\"\\")


def _key_paths(name: str) -> list[list[str]]:
    """Every way to read a dotted name: a literal key, nested keys, or a mix."""
    parts = name.split(".")
    paths = [[parts[0]]]
    for part in parts[1:]:
        paths = [p[:-1] + [f"{p[-1]}.{part}"] for p in paths] + [p + [part] for p in paths]
    return paths


def pick_fields(json: Column, names: list[str]) -> Column:
    """Only the named fields of a VARIANT object as ``MAP<STRING, STRING>``, null when absent.

    The paths are read straight from the variant, and a lookup in this map is
    simplified to the one path it asks for.
    """

    def read(path: list[str]) -> Column:
        at = "$" + "".join(f'["{key}"]' for key in path)
        value = F.try_variant_get(json, at, "string")
        # an object is not a field, what is inside it is
        inside = F.try_variant_get(json, at, "map<string,variant>")
        return F.when(~F.startswith(value, F.lit("{")) | inside.isNull(), value)

    pairs = []
    for name in names:
        pairs += [F.lit(name), F.coalesce(*[read(path) for path in _key_paths(name)])]
    return F.create_map(*pairs)


def parse_lines(
    df: DataFrame, line: str = "raw", fields: list[str] | None = None, max_depth: int | None = None
) -> DataFrame:
    """Add ``attrs`` (flattened fields) and set ``raw`` from a text column.

    Blank lines are dropped. ``raw`` is the trimmed line, unless the object has
    an ``@raw`` field of its own. With ``fields``, ``attrs`` holds just those
    (null when absent) and ``@raw``, which is several times cheaper: name them when a query uses a known few.

    The parse is computed once per row (:func:`with_once`).
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (line, "raw", "attrs")]
    text = df.select(*rest, trimmed(F.col(f"`{line}`")).alias("_line")).filter("_line <> ''")
    looks = F.startswith("_line", F.lit("{"))
    staged = with_once(text, "_first", F.when(looks, F.try_parse_json("_line")))
    json = json_object("_line", "_first")
    wanted = None if fields is None else list(dict.fromkeys([*fields, "@raw"]))
    if wanted is not None and all(_pickable(name) for name in wanted):
        attrs = pick_fields(json, wanted)
        own = attrs["@raw"]
    else:
        flat = F.when(json.isNotNull(), flatten(json, max_depth, _braces(F.col("_line")))).otherwise(
            F.create_map().cast("map<string,string>")
        )
        staged = with_once(staged, "attrs", flat)
        attrs = F.col("attrs")
        own = F.try_element_at(attrs, F.lit("@raw"))
        if wanted is not None:
            attrs = F.create_map(*[c for n in wanted for c in (F.lit(n), F.try_element_at(F.col("attrs"), F.lit(n)))])
    return staged.select(*rest, F.coalesce(own, F.col("_line")).alias("raw"), attrs.alias("attrs"))


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    fields: list[str] | None = None,
    max_depth: int | None = None,
) -> DataFrame:
    """NDJSON or plain-text files (any mix, gzip too) -> ``raw``, ``attrs``."""
    return parse_lines(spark.read.text(path, lineSep="\n"), "value", fields, max_depth)


def first_lines(spark: SparkSession, path: str, n: int, keep: Column | None = None) -> DataFrame:
    """The first ``n`` lines under ``path`` in input order, blank ones left out: ``place`` (from 1), ``value``.

    Files follow their paths, lines their place in the file; ``keep`` (on ``value``) chooses lines before they are
    counted. Reading stops early: files are read in growing groups until there are enough lines, and of a
    group every task hands on ``n`` lines at most.
    """
    files = sorted(spark.read.text(path).inputFiles())
    at, width, left, found = 0, 1, n, []
    while at < len(files) and left > 0:
        group = spark.read.text(files[at : at + width], lineSep="\n")
        kept = group.filter(trimmed(F.col("value")) != "")
        kept = kept if keep is None else kept.filter(keep)
        # within a split rows come in order, and the row id grows with them
        order = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
        first = kept.select("value", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("_order"))
        first = materialize(first.orderBy("_order").limit(left))
        found.append(first.select("value", F.struct(F.lit(at).alias("g"), "_order").alias("_order")))
        left -= first.count()
        at, width = at + width, width * 4
    if not found:
        return spark.createDataFrame([], "place bigint, value string")
    lines = reduce(DataFrame.unionByName, found)
    place = F.row_number().over(Window.orderBy("_order")).cast("bigint")  # n rows at most
    return lines.select(place.alias("place"), "value")
