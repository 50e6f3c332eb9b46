from starloom.operators.location import build_location_hierarchy, clean_address_process, parse_address


def raw(spark, *addresses):
    return spark.createDataFrame([(a,) for a in addresses], "purchase_address string")


def test_parse_address_parts(spark):
    r = parse_address(raw(spark, " 380 North St, Los Angeles, CA 90001", "no commas", None,
                          "1 A St, B, CA 90001 ")).collect()
    assert tuple(r[0]) == ("380 North St", "Los Angeles", "CA", "90001")
    assert tuple(r[1]) == ("no commas", "", "", "commas")
    assert tuple(r[2]) == (None, None, None, None)
    # Parsing runs on the raw text: a trailing space leaves an empty last word.
    assert r[3]["postal_code"] == ""


def test_clean_address_process_filters_and_normalises(spark):
    out = clean_address_process(raw(spark, "1 A St, X, ca 90001", "1 A St, X, ca 90001", "2 B St, Y, WA N/A",
                                    None, "3 C St, Z, , 12345")).collect()
    assert sorted(tuple(r) for r in out) == [("1 A St", "X", "CA", "90001"), ("3 C St", "Z", "", "12345")]


def tree(spark, mode, *addresses):
    h, keys = build_location_hierarchy(clean_address_process(raw(spark, *addresses)), mode)
    return {r["address_id"]: r for r in h.collect()}, keys.collect()


ADDRS = ("10 Oak St, Portland, ME 04101", "5 Elm St, Portland, OR 97035", "7 Pine St, Portland, OR 97035",
         "1 Main St, Austin, TX 73301", "2 Main St, Dallas, TX 73301", "9 Bay St, Boston, MA 73301")


def test_full_path_hierarchy(spark):
    nodes, keys = tree(spark, "city_postal", *ADDRS)
    levels = sorted(r["level"] for r in nodes.values())
    assert levels.count(3) == 4 and levels.count(2) == 4
    # Two Portland nodes (two postal codes); two cities numbered under one postal.
    assert nodes["S-ME04101-C00001"]["address_name"] == "Portland"
    assert nodes["S-OR97035-C00001"]["address_name"] == "Portland"
    assert nodes["S-TX73301-C00001"]["address_name"] == "Austin"
    assert nodes["S-TX73301-C00002"]["address_name"] == "Dallas"
    # A postal code in two states gives one node per state.
    assert nodes["S-MA73301"]["parent_id"] == "S-MA"
    assert nodes["S-OR97035-C00001-S00001"]["address_name"] == "5 Elm St"
    assert nodes["S-OR97035-C00001-S00002"]["address_name"] == "7 Pine St"
    assert len(keys) == 6
    # every parent exists
    assert all(r["parent_id"] is None or r["parent_id"] in nodes for r in nodes.values())


def test_city_name_lookup_mode(spark):
    nodes, _ = tree(spark, "city", *ADDRS)
    # Streets find their city by name only: all Portland streets hang under the smallest Portland id.
    portland = sorted(k for k, r in nodes.items() if r["level"] == 1 and r["address_name"] == "Portland")
    streets = [r for r in nodes.values() if r["level"] == 0 and r["address_name"] in ("10 Oak St", "5 Elm St", "7 Pine St")]
    assert {r["parent_id"] for r in streets} == {portland[0]}
    # The postal in two states: cities find the smallest postal node id.
    boston = [r for r in nodes.values() if r["address_name"] == "Boston"][0]
    assert boston["parent_id"] == "S-MA73301"
