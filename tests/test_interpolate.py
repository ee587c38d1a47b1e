from zonage.operators import interpolate as I


def line_graph(spark, n):
    pairs = [(i, i + 1) for i in range(n - 1)] + [(i + 1, i) for i in range(n - 1)]
    return spark.createDataFrame(pairs, "zone int, nzone int")


def sequential(values, pairs, passes=3):
    """Zone by zone in the given order, as the definition says."""
    import statistics
    from decimal import ROUND_HALF_UP, Decimal
    two = lambda x: float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))
    v = dict(values)
    for _ in range(passes):
        for z in [z for z, _ in values if v[z] is None]:
            near = [v[b] for a, b in pairs if a == z and v[b] is not None]
            if near:
                v[z] = two(sum(near) / len(near))
    known = [x for x in v.values() if x is not None]
    return {z: two(statistics.median(known)) if x is None and known else (None if x is None else two(x)) for z, x in v.items()}


def test_chain_of_four_missing(spark):
    vals = [(0, 10.0), (1, None), (2, None), (3, None), (4, None), (5, 20.0)]
    df = spark.createDataFrame(vals, "zone int, v double")
    got = {r.zone: r.v for r in I.fill_from_neighbours(df, line_graph(spark, 6), "zone", "v").collect()}
    # 1, 2 and 3 one after the other from the left, 4 from both sides
    assert got == {0: 10.0, 1: 10.0, 2: 10.0, 3: 10.0, 4: 15.0, 5: 20.0}


def test_random_graphs_in_file_order(spark):
    import random
    r = random.Random(3)
    for n, links, known in ((12, 20, 0.3), (25, 60, 0.5), (25, 30, 0.1)):
        zones = [f"z{k}" for k in r.sample(range(100), n)]          # the file's order is not that of the codes
        vals = [(z, float(r.randrange(0, 400)) / 4 if r.random() < known else None) for z in zones]
        links = {tuple(sorted(r.sample(zones, 2))) for _ in range(links)}
        pairs = sorted(links | {(b, a) for a, b in links})
        df = spark.createDataFrame([(z, v, k) for k, (z, v) in enumerate(vals)], "zone string, v double, at int").repartition(3)
        got = I.fill_from_neighbours(df, spark.createDataFrame(pairs, "zone string, nzone string"), "zone", "v", order="at")
        assert {x.zone: x.v for x in got.collect()} == sequential(vals, pairs)


def test_leftover_gets_median(spark):
    vals = [(0, 1.0), (1, 3.0), (2, None), (3, None), (4, None), (5, None), (6, None)]
    pairs = spark.createDataFrame([(2, 3), (3, 2), (3, 4), (4, 3), (4, 5), (5, 4), (5, 6), (6, 5)],
                                  "zone int, nzone int")
    df = spark.createDataFrame(vals, "zone int, v double")
    got = {r.zone: r.v for r in I.fill_from_neighbours(df, pairs, "zone", "v").collect()}
    assert {got[z] for z in range(2, 7)} == {2.0}


def test_all_missing_stays_null(spark):
    df = spark.createDataFrame([(0, None), (1, None)], "zone int, v double")
    got = {r.zone: r.v for r in I.fill_from_neighbours(df, line_graph(spark, 2), "zone", "v").collect()}
    assert got == {0: None, 1: None}
