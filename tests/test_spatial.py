import random

from pyspark.sql import functions as F

from zonage.operators import spatial as G
from zonage.sources import lattice as LT

def _f(x):
    return [_f(v) for v in x] if isinstance(x, list) else float(x)


SQUARE_WITH_HOLE = _f([[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]])
TWO_PARTS = _f([[[[10, 0], [12, 0], [12, 2], [10, 2]]], [[[20, 0], [22, 0], [22, 2], [20, 2]]]])


def layer(spark):
    df = spark.createDataFrame([("holed", [SQUARE_WITH_HOLE]), ("multi", TWO_PARTS)],
                               "zone string, coords array<array<array<array<double>>>>")
    return G.polygon_edges(df, "zone", "coords")


def test_point_in_polygon_hole_multipolygon_outside(spark):
    pts = spark.createDataFrame([
        (1, 0.5, 0.5),   # interior of the shell
        (2, 2.0, 2.0),   # inside the hole -> outside
        (3, 11.0, 1.0),  # first part of the multipolygon
        (4, 21.0, 1.5),  # second part
        (5, 15.0, 1.0),  # between the parts
        (6, None, 1.0),  # missing coordinate
    ], "id int, x double, y double")
    got = {r.id: r.zone for r in G.points_in_zones(pts, layer(spark), "x", "y", cell=2.0).collect()}
    assert got == {1: "holed", 2: None, 3: "multi", 4: "multi", 5: None, 6: None}


def test_boundary_point_strict(spark):
    pts = spark.createDataFrame([(1, 0.0, 2.0), (2, 4.0, 2.0), (3, 2.0, 0.5)], "id int, x double, y double")
    e = layer(spark)
    half_open = {r.id: r.zone for r in G.points_in_zones(pts, e, "x", "y", cell=2.0).collect()}
    strict = {r.id: r.zone for r in G.points_in_zones(pts, e, "x", "y", cell=2.0, strict=True).collect()}
    assert strict == {1: None, 2: None, 3: "holed"}
    assert half_open[3] == "holed"


def test_lattice_is_a_partition(spark):
    nation = spark.createDataFrame([(i,) for i in range(25)], "n_nationkey int")
    ze = LT.zone_edges(nation)
    rnd = random.Random(11)
    pts = spark.createDataFrame([(i, rnd.uniform(0, 5), rnd.uniform(0, 5)) for i in range(400)],
                                "id int, x double, y double")
    idx = G.zone_index(ze, 1.0)
    all_hits = G.points_in_zones_all(pts, idx, "x", "y", 1.0)
    per_point = all_hits.groupBy("id").count().agg(F.max("count")).first()[0]
    assert per_point == 1
    assert all_hits.count() == 400
    area = G.polygon_area(ze).agg(F.sum("area")).first()[0]
    assert abs(area - 25.0) < 1e-9


def test_adjacency_king_moves(spark):
    nation = spark.createDataFrame([(i,) for i in range(25)], "n_nationkey int")
    adj = G.adjacency(LT.zone_edges(nation), 1.0)
    assert adj.count() == 144
    assert adj.filter(F.col("zone") == F.col("nzone")).count() == 0


def test_within_and_intersects_boxes(spark):
    nation = spark.createDataFrame([(i,) for i in range(25)], "n_nationkey int")
    ze = LT.zone_edges(nation)
    boxes = spark.createDataFrame([
        (1, 0.1, 0.1, 0.2, 0.2),    # inside zone 0
        (2, 0.7, 0.2, 0.8, 0.2),    # straddles zones 0 and 1
        (3, -2.0, -2.0, 10.0, 10.0),  # covers everything
        (4, 7.0, 7.0, 0.5, 0.5),    # outside
    ], "id long, bx double, by double, bw double, bh double")
    be = G.box_edges(boxes, "id", "bx", "by", "bw", "bh")
    within = {(r.fid, r.zone) for r in G.features_in_zones(be, ze, "within", 1.0).collect()}
    assert within == {(1, 0)}
    inter = G.features_in_zones(be, ze, "intersects", 1.0)
    got = {}
    for r in inter.collect():
        got.setdefault(r.fid, set()).add(r.zone)
    assert got[1] == {0} and got[2] == {0, 1} and len(got[3]) == 25 and 4 not in got


def test_overlay_area_conserves_box_area(spark):
    nation = spark.createDataFrame([(i,) for i in range(25)], "n_nationkey int")
    ze = LT.zone_edges(nation)
    boxes = spark.createDataFrame([
        (1, 0.1, 0.1, 0.2, 0.2),      # inside one zone
        (2, 0.7, 0.2, 0.8, 0.2),      # straddles two zones
        (3, 1.5, 1.5, 2.3, 1.9),      # spans several zones
        (4, -0.5, 4.5, 1.0, 1.0),     # partly outside the mosaic
    ], "id long, bx double, by double, bw double, bh double")
    be = G.box_edges(boxes, "id", "bx", "by", "bw", "bh")
    got = {r.fid: r.a for r in G.overlay_area(be, ze, 1.0).groupBy("fid").agg(F.sum("area").alias("a")).collect()}
    expected = {1: 0.04, 2: 0.16, 3: 2.3 * 1.9, 4: 0.5 * 0.5}
    for k, v in expected.items():
        assert abs(got[k] - v) < 1e-9, (k, got[k], v)


def test_overlay_coincident_edges(spark):
    zones = spark.createDataFrame([("a", [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]]),
                                   ("b", [[[[1.0, 0.0], [2.0, 0.0], [2.0, 1.0], [1.0, 1.0]]]])],
                                  "zone string, coords array<array<array<array<double>>>>")
    feats = spark.createDataFrame([("same", [[[[1.0, 0.0], [1.5, 0.0], [1.5, 1.0], [1.0, 1.0]]]]),   # shares b's left edge
                                   ("equal", [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]])],  # equals zone a
                                  "fid string, coords array<array<array<array<double>>>>")
    ze = G.polygon_edges(zones, "zone", "coords")
    fe = G.polygon_edges(feats, "fid", "coords")
    got = {(r.fid, r.zone): r.area for r in G.overlay_area(fe, ze, 1.0).collect()}
    assert abs(got[("same", "b")] - 0.5) < 1e-12 and abs(got.get(("same", "a"), 0.0)) < 1e-12
    assert abs(got[("equal", "a")] - 1.0) < 1e-12 and abs(got.get(("equal", "b"), 0.0)) < 1e-12


def shapes(spark, rows):
    """Edge table of ``(id, parts)`` rows; a part is a list of rings."""
    return G.polygon_edges(spark.createDataFrame(rows, "id string, c array<array<array<array<double>>>>"), "id", "c")


def box(x0, y0, x1, y1):
    return [[float(x0), float(y0)], [float(x1), float(y0)], [float(x1), float(y1)], [float(x0), float(y1)]]


def pairs(df):
    return sorted((r.fid, r.zone) for r in df.collect())


ZONES = [("A", [[box(0, 0, 10, 10)]]), ("B", [[box(20, 0, 30, 10)]]),
         ("H", [[box(40, 0, 60, 20), box(45, 5, 50, 10)]]),                       # with a hole
         ("L", [[[[70.0, 0.0], [90.0, 0.0], [90.0, 10.0], [80.0, 10.0], [80.0, 20.0], [70.0, 20.0]]]])]  # reflex corner


def test_every_part_of_a_feature_counts(spark):
    """One part in A, one wholly inside B: both meet, each with area 1."""
    f = shapes(spark, [("two", [[box(1, 1, 2, 2)], [box(22, 2, 23, 3)]])])
    z = shapes(spark, ZONES)
    assert pairs(G.features_in_zones(f, z, "intersects", 5.0)) == [("two", "A"), ("two", "B")]
    assert {(r.fid, r.zone): round(r.area, 9) for r in G.overlay_area(f, z, 5.0).collect()} == {("two", "A"): 1.0, ("two", "B"): 1.0}
    assert pairs(G.features_in_zones(f, z, "within", 5.0)) == []


def test_every_part_of_a_zone_counts(spark):
    f = shapes(spark, [("big", [[box(0, 0, 100, 100)]])])
    z = shapes(spark, [("parts", [[box(200, 200, 210, 210)], [box(50, 50, 51, 51)]])])
    assert pairs(G.features_in_zones(f, z, "intersects", 10.0)) == [("big", "parts")]
    assert [round(r.area, 9) for r in G.overlay_area(f, z, 10.0).collect()] == [1.0]


def test_within_allows_contact_and_minds_holes(spark):
    f = shapes(spark, [
        ("flush upper right", [[box(8, 8, 10, 10)]]), ("flush lower left", [[box(0, 0, 2, 2)]]), ("whole", [[box(0, 0, 10, 10)]]),
        ("inside", [[box(3, 3, 4, 4)]]), ("over the edge", [[box(9, 9, 11, 11)]]), ("along the edge", [[box(0, 8, 12, 10)]]),
        ("around the hole", [[box(44, 4, 52, 12)]]), ("in the hole", [[box(46, 6, 47, 7)]]), ("beside the hole", [[box(50, 5, 55, 10)]]),
        ("ring round the hole", [[box(44, 4, 52, 12), box(45, 5, 50, 10)]]),
        ("through the corner", [[[[75.0, 19.0], [75.0, 18.0], [89.0, 8.0], [89.0, 9.0]]]]),
        ("into the corner", [[box(75, 5, 80, 10)]]), ("both arms", [[[[71.0, 1.0], [89.0, 1.0], [71.0, 19.0]]]])])
    z = shapes(spark, ZONES)
    for cell in (3.0, 10.0, None):
        assert pairs(G.features_in_zones(f, z, "within", cell)) == sorted([
            ("flush upper right", "A"), ("flush lower left", "A"), ("whole", "A"), ("inside", "A"),
            ("beside the hole", "H"), ("ring round the hole", "H"), ("into the corner", "L"), ("both arms", "L")])


def test_zones_whose_boundaries_cross_are_neighbours(spark):
    z = shapes(spark, [("a", [[box(0, 0, 10, 10)]]), ("b", [[box(5, 5, 15, 15)]]), ("c", [[box(15, 8, 20, 9)]]),
                       ("d", [[box(40, 40, 41, 41)]]), ("e", [[box(1, 1, 2, 2)]])])
    got = sorted((r.zone, r.nzone) for r in G.adjacency(z, 5.0).collect())
    assert got == [("a", "b"), ("b", "a"), ("b", "c"), ("c", "b")]


def test_overlay_of_random_boxes(spark):
    import random
    r = random.Random(4)
    boxes = lambda n: [(f"{i}", *(lambda x, y: (x, y, x + r.randrange(1, 9), y + r.randrange(1, 9)))(r.randrange(20), r.randrange(20)))
                       for i in range(n)]
    fs, zs = boxes(12), boxes(12)
    want = {}
    for i, a, b, c, d in fs:
        for j, e, f, g, h in zs:
            w, t = min(c, g) - max(a, e), min(d, h) - max(b, f)
            if w >= 0 and t >= 0:
                want[i, j] = float(w * t)
    f, z = (shapes(spark, [(i, [[box(*b)]]) for i, *b in x]) for x in (fs, zs))
    assert pairs(G.features_in_zones(f, z, "intersects", 4.0)) == sorted(want)
    got = {(x.fid, x.zone): round(x.area, 9) for x in G.overlay_area(f, z, 4.0).collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    inside = sorted((i, j) for i, a, b, c, d in fs for j, e, g, h, k in zs if e <= a and g <= b and c <= h and d <= k)
    assert pairs(G.features_in_zones(f, z, "within", 4.0)) == inside


# ------------------------------------------------------------ levels of cells

def sized_boxes(spark, boxes):
    """Edge table of boxes ``{id: (x, y, side)}``."""
    df = spark.createDataFrame([(k, float(x), float(y), float(w)) for k, (x, y, w) in boxes.items()],
                               "id string, x double, y double, w double")
    return G.box_edges(df, "id", "x", "y", "w", "w")


COUNTRY = {"country": (-500_000, -500_000, 1_000_000)}
STREETS = {f"s{i}": (3 * i, 2 * i, 1) for i in range(40)}


def test_index_of_a_country_beside_streets_takes_few_cells(spark):
    idx = G.zone_index(sized_boxes(spark, COUNTRY | STREETS), 1.0)
    by_level = {r["level"]: r["count"] for r in idx.groupBy("level").count().collect()}
    assert len(by_level) == 2 and by_level[0] <= 4 * len(STREETS)
    assert by_level[max(by_level)] <= (G.SPAN + 1) ** 2
    assert idx.select(F.explode("zones").alias("z")).agg(F.sum(F.size("z.edges"))).first()[0] <= 1000


def test_pairs_of_boxes_of_all_sizes_meet_once(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.uniform(-50, 50), rnd.uniform(-50, 50), 10 ** rnd.uniform(-3, 3)) for i in range(120)]
    rows += [(200, 0.0, 0.0, 0.0), (201, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "i int, x double, y double, w double")
    box = (F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("w"))
    got = [(r.i, r.k) for r in G.boxes_sharing_cells(df, box, df, box, 0.5)
           .select(F.col("a_i").alias("i"), F.col("b_i").alias("k")).collect()]
    assert len(got) == len(set(got))
    whole = [r for r in rows if r[1] is not None]
    want = {(a[0], b[0]) for a in whole for b in whole
            if a[1] <= b[1] + b[3] and b[1] <= a[1] + a[3] and a[2] <= b[2] + b[3] and b[2] <= a[2] + a[3]}
    assert want <= set(got)
    assert not {k for pair in got for k in pair} & {201}


def test_box_rows_grow_with_boxes_not_with_their_area(spark):
    edges = sized_boxes(spark, COUNTRY | STREETS)
    boxes = G._boxed(edges, G.edge_box(), 1.0, "a")
    levels = G.box_levels(1.0, a=(edges, G.edge_box()))["a"]
    assert len(levels) == 2
    rows = G._on_levels(boxes, levels, levels, 1.0, "a").count()
    assert rows <= 10 * edges.count()


def test_points_lie_in_zones_of_every_level(spark):
    zones = COUNTRY | STREETS | {"town": (-300, -300, 200)}
    rnd = random.Random(8)
    pts = [(i, rnd.uniform(-400, 150), rnd.uniform(-400, 100)) for i in range(300)]
    pts += [(1000 + i, x + 0.5, y + 0.5) for i, (x, y, _) in enumerate(STREETS.values())]
    pts += [(2000, 600_000.0, 0.0), (2001, None, 0.0)]
    df = spark.createDataFrame(pts, "id int, x double, y double")
    edges = sized_boxes(spark, zones)
    got = {}
    for r in G.points_in_zones_all(df, G.zone_index(edges, 1.0), "x", "y", 1.0).collect():
        got.setdefault(r.id, set()).add(r.zone)
    want = {i: {k for k, (zx, zy, w) in zones.items() if x is not None and zx < x < zx + w and zy < y < zy + w}
            for i, x, y in pts}
    assert got == {i: z for i, z in want.items() if z}
    one = G.points_in_zones(df, edges, "x", "y", 1.0)
    assert {r.id: r.zone for r in one.collect()} == {i: min(z, default=None) for i, z in want.items()}
    empty = G.points_in_zones(df, edges.filter("false"), "x", "y", 1.0)
    assert {r.zone for r in empty.collect()} == {None}


def test_predicates_across_sizes(spark):
    zones = COUNTRY | {"town": (-300, -300, 200), "far": (900_000, 0, 5)}
    feats = {"in_town": (-250, -250, 1), "on_border": (-301, -200, 3), "abroad": (499_999, 0, 2),
             "holds_far": (800_000, -100_000, 300_000)}
    f, z = sized_boxes(spark, feats), sized_boxes(spark, zones)
    pairs = lambda how: {(r.fid, r.zone) for r in G.features_in_zones(f, z, how, 1.0).collect()}
    assert pairs("intersects") == {("in_town", "town"), ("in_town", "country"), ("on_border", "town"),
                                   ("on_border", "country"), ("abroad", "country"), ("holds_far", "far")}
    assert pairs("within") == {("in_town", "town"), ("in_town", "country"), ("on_border", "country")}
    areas = {(r.fid, r.zone): r.area for r in G.overlay_area(f, z, 1.0).collect()}
    want = {("in_town", "town"): 1.0, ("in_town", "country"): 1.0, ("on_border", "town"): 6.0,
            ("on_border", "country"): 9.0, ("abroad", "country"): 2.0, ("holds_far", "far"): 25.0}
    # Coordinates of half a million leave an area of 2 some five digits.
    assert areas.keys() == want.keys() and all(abs(areas[k] - v) < 1e-4 for k, v in want.items())
