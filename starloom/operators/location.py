"""Address parsing and the four-level location hierarchy (O-08..O-13).

Levels: 3 State ``S-<state>``; 2 Postal Code ``S-<state><postal>``;
1 City ``<postal node>-C%05d``; 0 Street ``<city node>-S%05d``. Counters
number siblings in name order (the source used arbitrary DISTINCT order);
nodes stored by an earlier run keep their ids.

``parent_match``:
  * ``city_postal`` (default) - every node is keyed by its full path, so a
    city name under two postal codes, or a postal code in two states, gives
    separate nodes and each address maps to exactly one street node.
  * ``city`` - the source's lookup: a city finds its postal node by postal
    code only and a street finds its city node by city name only; when
    several match, the smallest address_id is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import counter, is_digits, part
from starloom.operators.keys import group_sequence
from starloom.session import DENSE, cut_lineage

ADDRESS_PARTS = ("street", "city", "state", "postal_code")


def parse_address(df: DataFrame, col: str = "purchase_address") -> DataFrame:
    """O-08: ``Street, City, ST 12345`` -> four trimmed parts ('' when missing)."""
    a = F.col(col)
    return df.select(
        F.trim(part(a, ",", 1)).alias("street"),
        F.trim(part(a, ",", 2)).alias("city"),
        F.trim(part(part(a, ",", 3), " ", 2)).alias("state"),
        F.trim(part(a, " ", -1)).alias("postal_code"),
    )


def address_key_columns(col: str = "purchase_address") -> dict:
    """Parsed and normalised parts (O-08 + O-11) as columns ``_street`` ... ``_postal``."""
    a = F.col(col)
    return {
        "_street": F.trim(part(a, ",", 1)),
        "_city": F.trim(part(a, ",", 2)),
        "_state": F.upper(F.trim(part(part(a, ",", 3), " ", 2))),
        "_postal": F.trim(part(a, " ", -1)),
    }


def dedup_addresses(df: DataFrame) -> DataFrame:
    """O-09: distinct, all four parts present ('' counts as present)."""
    cond = F.lit(True)
    for c in ADDRESS_PARTS:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond).select(*ADDRESS_PARTS).distinct()


def filter_postal(df: DataFrame) -> DataFrame:
    """O-10: postal codes made of digits only."""
    return df.filter(is_digits("postal_code"))


def normalise_address(df: DataFrame) -> DataFrame:
    """O-11: trim street and city, upper-case the state."""
    return df.select(F.trim("street").alias("street"), F.trim("city").alias("city"),
                     F.upper("state").alias("state"), "postal_code")


def clean_address_process(raw: DataFrame, col: str = "purchase_address", written: bool = False) -> DataFrame:
    """O-13 (first half): raw landing rows -> final staging addresses. Equal texts are parsed once:
    the distinct ones are written (``written``: ``raw`` holds them so already), or the optimizer moves the filters on the parsed parts down to every row."""
    texts = raw.select(col) if written else cut_lineage(raw.select(col).distinct(), "address-texts")
    return normalise_address(filter_postal(dedup_addresses(parse_address(texts, col))))


def _nodes(df: DataFrame, id_col, name_col, level: int, parent_col) -> DataFrame:
    from starloom.schemas import LOCATION_TYPES
    return df.select(
        id_col.alias("address_id"), name_col.alias("address_name"),
        F.lit(LOCATION_TYPES[level]).alias("address_type"),
        parent_col.cast("string").alias("parent_id"), F.lit(level).alias("level"))


def _suffix(node_id, kind: str):
    """The sibling number at the end of a city (``C``) or street (``S``) id."""
    return F.regexp_extract(node_id, rf"-{kind}(\d+)$", 1).cast("long")


def _numbered_after(fresh: DataFrame, known: DataFrame | None, groups: list[str], names: list[str]) -> DataFrame:
    """``groups``, ``names``, ``_n``: stored nodes with their number, new ones numbered in name order after
    the largest number of their group. Without stored nodes every node is new."""
    if known is None:
        return group_sequence(fresh, groups, names, "_n")

    def same(left: DataFrame, right: DataFrame, cols: list[str]):
        return [left[c].eqNullSafe(right[c]) for c in cols]

    known = known.select(*groups, *names, "_n")
    largest = known.groupBy(*groups).agg(F.max("_n").alias("_most"))
    new = group_sequence(fresh.join(known, same(fresh, known, groups + names), "left_anti"), groups, names, "_n")
    new = new.join(largest, same(new, largest, groups), "left").select(
        *[new[c] for c in groups + names], (F.col("_n") + F.coalesce("_most", F.lit(0))).alias("_n"))
    return known.unionByName(new)


def build_location_hierarchy(addresses: DataFrame, parent_match: str = "city_postal",
                             stored: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """O-12: (hierarchy, street_keys).

    ``street_keys`` maps the address parts that identify a street node to its
    ``address_id`` and ``parent_id`` (full path in ``city_postal`` mode,
    street/city/postal in ``city`` mode); the keyed fact join uses it and
    needs no second join with the hierarchy.

    ``stored`` is what an earlier call returned for a subset of ``addresses``:
    its cities and streets keep their ids, and new siblings are numbered after
    the largest number of their parent (O-63). ``addresses`` are distinct and
    hold the stored ones too.
    """
    # The distinct addresses feed all four levels: materialise them once.
    a = cut_lineage(addresses.select(*ADDRESS_PARTS), "addresses")
    states = _nodes(a.select("state").distinct(), F.concat(F.lit("S-"), F.col("state")),
                    F.col("state"), 3, F.lit(None))
    postal_pairs = a.select("postal_code", "state").distinct()
    postals = _nodes(postal_pairs,
                     F.concat(F.lit("S-"), F.col("state"), F.trim("postal_code")),
                     F.col("postal_code"), 2, F.concat(F.lit("S-"), F.col("state")))

    if parent_match == "city_postal":
        # Cities (within their postal node) and streets (within their city's
        # path) are numbered in one skew-safe pass: a street's group is its
        # (state, postal, city) key, so it does not wait for the city ids.
        no_city = F.lit(None).cast("string").alias("_gcity")
        cities_src = a.select("state", "postal_code", no_city, F.col("city").alias("_name"),
                              F.lit(1).alias("_lvl")).distinct()
        streets_src = a.select("state", "postal_code", F.col("city").alias("_gcity"),
                               F.col("street").alias("_name"), F.lit(0).alias("_lvl")).distinct()
        known = None
        if stored is not None:
            # Every stored city has a stored street, whose parent it is.
            k = stored[1]
            known = k.select("state", "postal_code", no_city, F.col("city").alias("_name"), F.lit(1).alias("_lvl"),
                             _suffix("parent_id", "C").alias("_n")).distinct().unionByName(
                k.select("state", "postal_code", F.col("city").alias("_gcity"), F.col("street").alias("_name"),
                         F.lit(0).alias("_lvl"), _suffix("address_id", "S").alias("_n")))
        # (the numbering materialises its ranked input, so re-reading this is cheap and stable)
        numbered = _numbered_after(cities_src.unionByName(streets_src), known,
                                   ["_lvl", "state", "postal_code", "_gcity"], ["_name"])
        postal_id = F.concat(F.lit("S-"), F.col("state"), F.trim("postal_code"))
        cities_k = numbered.filter("_lvl = 1").select(
            F.col("_name").alias("city"), "postal_code", "state", postal_id.alias("_parent"),
            F.concat(postal_id, F.lit("-C"), counter(F.col("_n"))).alias("_id"))
        cities = _nodes(cities_k, F.col("_id"), F.col("city"), 1, F.col("_parent"))
        streets_k = (numbered.filter("_lvl = 0")
                     .select(F.col("_name").alias("street"), F.col("_gcity").alias("city"),
                             "postal_code", "state", "_n")
                     .join(cities_k.select("city", "postal_code", "state", F.col("_id").alias("_parent")),
                           ["city", "postal_code", "state"])
                     .withColumn("address_id", F.concat(F.col("_parent"), F.lit("-S"), counter(F.col("_n")))))
        # Two consumers (the nodes and the keys): written once.
        streets_k = cut_lineage(streets_k.drop("_n"), "streets", DENSE)
        streets = _nodes(streets_k, F.col("address_id"), F.col("street"), 0, F.col("_parent"))
        keys = streets_k.select(*ADDRESS_PARTS, "address_id", F.col("_parent").alias("parent_id"))
    elif parent_match == "city":
        first_postal = postals.groupBy(F.col("address_name").alias("postal_code")).agg(
            F.min("address_id").alias("_parent"))
        cities_src = a.select("city", "postal_code").distinct().join(first_postal, "postal_code")
        known_cities = known_streets = None
        if stored is not None:
            # A stored city or street stays under the parent it was given: only new ones are looked up.
            nodes, k = stored
            postal = nodes.filter("level = 2").select(F.col("address_id").alias("_parent"),
                                                      F.col("address_name").alias("postal_code"))
            known_cities = nodes.filter("level = 1").select(
                F.col("address_name").alias("city"), F.col("parent_id").alias("_parent"),
                _suffix("address_id", "C").alias("_n")).join(postal, "_parent")
            known_streets = k.select("street", "city", "postal_code", F.col("parent_id").alias("_parent"),
                                     _suffix("address_id", "S").alias("_n"))
            cities_src = cities_src.join(known_cities.select("city", "postal_code"), ["city", "postal_code"], "left_anti")
        # Two consumers (the nodes and the streets' lookup): written once.
        cities_k = cut_lineage(_numbered_after(cities_src, known_cities, ["_parent"], ["city", "postal_code"]).withColumn(
            "_id", F.concat(F.col("_parent"), F.lit("-C"), counter(F.col("_n")))), "cities")
        cities = _nodes(cities_k, F.col("_id"), F.col("city"), 1, F.col("_parent"))
        first_city = cities_k.groupBy("city").agg(F.min("_id").alias("_parent"))
        streets_src = a.select("street", "city", "postal_code").distinct().join(first_city, "city")
        if known_streets is not None:
            streets_src = streets_src.join(known_streets.select("street", "city", "postal_code"),
                                           ["street", "city", "postal_code"], "left_anti")
        streets_k = _numbered_after(streets_src, known_streets, ["_parent"], ["street", "city", "postal_code"]) \
            .withColumn("address_id", F.concat(F.col("_parent"), F.lit("-S"), counter(F.col("_n"))))
        streets = _nodes(streets_k, F.col("address_id"), F.col("street"), 0, F.col("_parent"))
        keys = streets_k.select("street", "city", "postal_code", "address_id",
                                F.col("_parent").alias("parent_id"))
    else:
        raise ValueError(f"unknown parent_match {parent_match!r}")

    hierarchy = states.unionByName(postals).unionByName(cities).unionByName(streets)
    return hierarchy, keys
