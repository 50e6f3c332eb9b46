"""Denormalised order fact (O-21, O-22).

Joins each clean sale to a product version, its main-branch day and one or
more location nodes. ``address_match``:

  * ``keyed`` (default): the sale's parsed address identifies exactly one
    street node (an equi join on the address parts).
  * ``substring``: the source's rule - every node whose name occurs inside
    the purchase address matches (``address LIKE '%' || name || '%'``), at
    every level. Instead of a nested-loop join, each distinct address is
    cut into its ``GRAM``-character pieces (one a character) and equi-joined
    with one piece of each distinct node name: the one that fewest addresses
    hold. The exact LIKE is then a residual on the candidates. Distinct
    addresses are matched once and joined back to the sales by address.

``price_mode``: ``current`` (source: quantity x current version's price) or
``as_of_sale`` (quantity x the version valid at the sale date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions.text import longest_literal_run
from starloom.operators.calendar import main_days
from starloom.operators.location import address_key_columns
from starloom.operators.product import join_valid_version
from starloom.session import DENSE, cut_lineage

_PCOL_NAMES = [("id", "_p_id"), ("product", "_p_product"), ("price_each", "_p_price"),
               ("start_date", "_p_start"), ("end_date", "_p_end"), ("curr_status", "_p_cur"),
               ("parent_id", "_p_parent"), ("category_name", "_p_cat")]

_FACT_TYPES = {
    "order_id": "bigint", "quantity": "bigint", "total_price": "decimal(38,2)",
    "product_surrogate_id": "bigint", "product": "string", "time_id": "string", "address_id": "string",
    "product_start_date": "date", "product_end_date": "date", "product_current_status": "boolean",
    "product_parent_id": "string", "product_category": "string", "time_name": "date",
    "time_parent": "string", "time_level": "string", "time_branch": "string",
    "address_name": "string", "address_type": "string", "parent_id": "string", "address_level": "int",
}


GRAM = 5
# Current versions that every task may hold (some 250 bytes each); more are joined once, by their name.
FEW_VERSIONS = 250_000
# Nodes of addresses that every task may hold (some 200 bytes each); for more, the sales are dealt by their address.
FEW_NODES = 100_000
# Distinct pieces of addresses that every task may hold (some 60 bytes each; an alphabet bounds them, not the number of addresses).
FEW_PIECES = 500_000


def _pieces(text, n):
    """All pieces of ``n`` characters of a text."""
    count = F.length(text) - n + 1
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda p: F.substring(text, p, n))).otherwise(F.array())


def substring_candidates(addresses: DataFrame, names: DataFrame) -> DataFrame:
    """(_addr, _name): pairs of a distinct address and a distinct node name that share the name's rarest piece.

    A name's pieces are those of its longest literal run, which any match holds word for word: of ``GRAM`` characters, or the
    whole run if that is shorter (none of a name of wildcards alone, which is compared with every address). An address has about one
    piece a character for each length in use, ``GRAM`` at most. While the distinct pieces are few (``FEW_PIECES``) every task holds them, and
    only the address pieces that are some name's rarest are dealt.
    """
    runs = names.select(F.col("address_name").alias("_name")).filter(F.col("_name").isNotNull()).distinct() \
        .withColumn("_run", longest_literal_run(F.col("_name")))
    size = F.least(F.length("_run"), F.lit(GRAM))
    # Lengths in use: GRAM + 1 numbers at most.
    sizes = sorted(r[0] for r in runs.select(size.alias("n")).distinct().collect())
    cut = F.array_distinct(F.concat(*[F.array(F.lit("")) if n == 0 else _pieces(F.col("_addr"), n) for n in sizes])) if sizes else F.array(F.lit(""))
    pieces = addresses.select("_addr", F.explode(cut).alias("_piece"))
    spread = cut_lineage(pieces.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n")), "pieces", DENSE)
    few = spread.count() <= FEW_PIECES
    mine = F.when(F.length("_run") == 0, F.array(F.lit(""))).otherwise(F.array_distinct(_pieces(F.col("_run"), size)))
    held = runs.select("_name", F.explode(mine).alias("_piece"))
    # A piece that no address holds rules its name out.
    rarest = (held.join(F.broadcast(spread) if few else spread, "_piece", "left").groupBy("_name")
              .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_piece")).alias("best"))
              .filter(F.col("best.n") > 0).select("_name", "best._piece"))
    if few:
        rarest = cut_lineage(rarest, "rarest-pieces", DENSE)
        pieces = pieces.join(F.broadcast(rarest.select("_piece").distinct()), "_piece", "left_semi")
    return pieces.join(rarest, "_piece").select("_addr", "_name")


def substring_matches(addresses: DataFrame, hierarchy: DataFrame, col: str = "purchase_address", also=()) -> DataFrame:
    """(address, address_id) for every node name contained in the address, with the node's columns ``also``."""
    addr = cut_lineage(addresses.select(F.col(col).alias("_addr")).filter(F.col("_addr").isNotNull()).distinct(), "addresses")
    nodes = hierarchy.select("address_id", F.col("address_name").alias("_name"), *also)
    hit = substring_candidates(addr, hierarchy).filter(F.like(F.col("_addr"), F.concat(F.lit("%"), F.col("_name"), F.lit("%"))))
    return hit.join(nodes, "_name").select(F.col("_addr").alias(col), "address_id", *also)


def current_versions(product: DataFrame) -> DataFrame:
    """The current versions with the columns the fact reads and ``_p_row``, a number of its own for every row.

    Written apart from the closed versions, which are several times as many: the planner sees their own size.
    """
    cur = product.filter("curr_status").select(*[F.col(src).alias(dst) for src, dst in _PCOL_NAMES])
    return cut_lineage(cur.withColumn("_p_row", F.monotonically_increasing_id()), "current-versions", DENSE)


def address_nodes(addresses: DataFrame, street_keys: DataFrame, col: str = "purchase_address") -> DataFrame:
    """_m_addr and its street node (_a_id, _a_name, _a_parent), one row per distinct address and node: each text is parsed once.

    The texts are written, or the join's conditions are moved down to every sale; so is the result, whose size
    is then known before the sales are joined with it.
    """
    texts = addresses.select(F.col(col).alias("_m_addr")).filter(F.col("_m_addr").isNotNull()).distinct()
    parsed = cut_lineage(texts, "address-texts").withColumns(address_key_columns("_m_addr"))
    # A street node is fully described by its key row: no join with the hierarchy.
    k = street_keys.select(
        *[F.col(c).alias(f"_k_{c}") for c in street_keys.columns if c not in ("address_id", "parent_id")],
        F.col("address_id").alias("_a_id"), F.col("street").alias("_a_name"), F.col("parent_id").alias("_a_parent"))
    cond = [parsed["_street"] == k["_k_street"], parsed["_city"] == k["_k_city"],
            parsed["_postal"] == k["_k_postal_code"]]
    if "_k_state" in k.columns:
        cond.append(parsed["_state"] == k["_k_state"])
    return cut_lineage(parsed.join(k, cond).select("_m_addr", "_a_id", "_a_name", "_a_parent"), "address-nodes", DENSE)


def build_order_fact(clean: DataFrame, product: DataFrame, time_dim: DataFrame,
                     hierarchy: DataFrame, street_keys: DataFrame | None = None,
                     address_match: str = "keyed", price_mode: str = "current",
                     addresses: DataFrame | None = None, deal_by: str | None = None) -> DataFrame:
    """The fact's rows. ``addresses``: texts (``purchase_address``) that hold all those of the sales, if known already; ``deal_by``: a column
    of ``clean`` (returned after the fact's own) by whose values keyed rows are dealt, while they are narrow."""
    sales = clean.filter(F.col("order_date").isNotNull())
    by = [] if deal_by is None else [deal_by]

    # -- product --------------------------------------------------------------
    named = None
    if price_mode == "current":
        versions = current_versions(product)
        few_versions = versions.count() <= FEW_VERSIONS
    elif price_mode == "as_of_sale":
        few_versions = False
    else:
        raise ValueError(f"unknown price_mode {price_mode!r}")

    def numbered(df: DataFrame) -> DataFrame:
        """Sales are dealt with the number of their version instead of its name, and with their day; other columns come afterwards."""
        nonlocal versions, named
        versions = F.broadcast(versions)
        named = F.broadcast(versions.select(F.upper("_p_product").alias("_p_key"), F.col("_p_row").alias("_p_at")))
        return (df.join(named, F.upper(df["product"]) == named["_p_key"]).drop("_p_key", "product")
                .withColumn("order_date", F.to_date("order_date")))

    def with_product(df: DataFrame) -> DataFrame:
        if named is not None:
            return df.join(versions, df["_p_at"] == versions["_p_row"]).drop("_p_at", "_p_row")
        if price_mode == "current":
            return df.join(versions, F.upper(df["product"]) == F.upper(versions["_p_product"])).drop("_p_row")
        return join_valid_version(df, product, "_v_").select(
            *df.columns, *[F.col("_v_" + src).alias(dst) for src, dst in _PCOL_NAMES])

    # -- location: before sales get wider ---
    if address_match == "keyed":
        if street_keys is None:
            raise ValueError("keyed address matching needs the street keys of the hierarchy")
        if few_versions:
            sales = numbered(sales)
        m = address_nodes(clean.select("purchase_address") if addresses is None else addresses, street_keys)
        located = sales.join(m, sales["purchase_address"] == m["_m_addr"])
        node = [F.lit("Street").alias("_a_type"), F.lit(0).alias("_a_level")]
    elif address_match == "substring":
        # Read several times, for the candidates and the nodes' columns: written once.
        nodes = cut_lineage(hierarchy.filter(F.col("address_id").isNotNull()), "hierarchy", DENSE)
        # A distinct address meets its nodes' columns before the sales do.
        m = substring_matches((sales if addresses is None else addresses).select("purchase_address"), nodes,
                              also=("address_name", "address_type", "parent_id", "level"))
        m = cut_lineage(m.select(
            F.col("purchase_address").alias("_m_addr"), F.col("address_id").alias("_a_id"), F.col("address_name").alias("_a_name"),
            F.col("address_type").alias("_a_type"), F.col("parent_id").alias("_a_parent"), F.col("level").alias("_a_level")), "address-nodes", DENSE)
        node = ["_a_type", "_a_level"]
        few_nodes = m.count() <= FEW_NODES
    else:
        raise ValueError(f"unknown address_match {address_match!r}")

    # -- time: main-branch days (size bounded by the covered years) --------------
    t = main_days(time_dim).select(
        F.col("time_id").alias("_t_id"), F.col("day_date").alias("_t_day"),
        F.col("time_parent").alias("_t_parent"), F.col("time_lvl").alias("_t_lvl"),
        F.col("timebranch").alias("_t_branch"))

    def with_day(df: DataFrame) -> DataFrame:
        return df.join(t, F.to_date(df["order_date"]) == t["_t_day"])

    if address_match == "keyed":
        if by:
            located = located.drop("_m_addr", "purchase_address", "updated_at").hint("rebalance", F.col(deal_by))
        located = with_day(with_product(located)).select("*", *node)
    elif few_versions and not few_nodes:
        # Dealt narrow: the sales' product and day are looked up once their nodes are there.
        sales = numbered(sales)
        located = with_day(with_product(sales.join(m, sales["purchase_address"] == m["_m_addr"])))
    else:
        # A sale has several nodes: it gets its product and day once, before them.
        spt = with_day(with_product(sales))
        located = spt.join(F.broadcast(m) if few_nodes else m, spt["purchase_address"] == m["_m_addr"])

    out = located.select(
        F.col("order_id"), F.col("quantity_ordered").alias("quantity"),
        (F.col("quantity_ordered") * F.col("_p_price")).alias("total_price"),
        F.col("_p_id").alias("product_surrogate_id"), F.col("_p_product").alias("product"),
        F.col("_t_id").alias("time_id"), F.col("_a_id").alias("address_id"),
        F.to_date("_p_start").alias("product_start_date"), F.to_date("_p_end").alias("product_end_date"),
        F.col("_p_cur").alias("product_current_status"), F.col("_p_parent").alias("product_parent_id"),
        F.col("_p_cat").alias("product_category"), F.col("_t_day").alias("time_name"),
        F.col("_t_parent").alias("time_parent"), F.col("_t_lvl").alias("time_level"),
        F.col("_t_branch").alias("time_branch"), F.col("_a_name").alias("address_name"),
        F.col("_a_type").alias("address_type"), F.col("_a_parent").alias("parent_id"),
        F.col("_a_level").alias("address_level"), *by,
    )
    return out.select(*[F.col(c).cast(_FACT_TYPES[c]).alias(c) for c in S.FACT_COLUMNS], *by)


def append_fact(existing: DataFrame | None, fresh: DataFrame, mode: str = "rebuild") -> DataFrame:
    """O-22: ``rebuild`` replaces the fact; ``append`` adds every row again (source)."""
    if mode == "rebuild" or existing is None:
        return fresh
    if mode == "append":
        return existing.unionByName(fresh)
    raise ValueError(f"unknown mode {mode!r}")
