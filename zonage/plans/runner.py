"""DP21: run chosen layers of the build in canonical order.

Layers always run in the order ``silver`` → ``gold`` → ``serving`` whatever
order they are given in, and inside ``gold`` the price indicators (DP2) run
before the affordability index (DP4) that reads them.  Each step is a
function ``(spark, ctx) -> None`` that reads its inputs from ``ctx`` (paths
or frames) and stores its outputs back, so a deployment wires its own
sources and sinks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

CANONICAL = ["silver", "gold", "serving"]
Step = Callable[[SparkSession, dict], None]


def canonical_order(layers: Iterable[str]) -> list[str]:
    wanted = set(layers)
    unknown = wanted - set(CANONICAL)
    if unknown:
        raise ValueError(f"unknown layers {sorted(unknown)}")
    return [x for x in CANONICAL if x in wanted]


def run(spark: SparkSession, layers: Iterable[str], steps: dict[str, list[tuple[str, Step]]],
        ctx: dict | None = None) -> list[str]:
    """Run ``steps[layer]`` for each requested layer in canonical order; the
    steps of a layer run in the order given (dependency order).  Returns the
    names of the steps run."""
    ctx = {} if ctx is None else ctx
    done = []
    for layer in canonical_order(layers):
        for name, step in steps.get(layer, []):
            step(spark, ctx)
            done.append(f"{layer}.{name}")
    return done


# --------------------------------------------------------------------------
# default wiring: landing files -> silver -> gold -> serving tables
# --------------------------------------------------------------------------

import os  # noqa: E402

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ..operators import load as L  # noqa: E402
from ..session import materialize  # noqa: E402
from . import contracts  # noqa: E402

# Load rule and key of every table written by the default
# wiring (anti-join append, composite anti-join append, insert-ignore,
# upsert, replace).
TABLE_RULES: dict[str, tuple[str, list[str]]] = {
    "silver/arbres": ("append_new", ["id"]),
    "silver/espaces_verts": ("append_new", ["id"]),
    "silver/ilots_fraicheur": ("append_new", ["id", "code_postal"]),
    "silver/trilib": ("append_new", ["id"]),
    "silver/map_arrets": ("insert_ignore", ["arret_id"]),
    "silver/map_gares": ("insert_ignore", ["gare_id"]),
    "silver/map_velib": ("insert_ignore", ["station_id"]),
    "silver/dvf": ("append_new", ["id_mutation"]),
    "silver/filosofi": ("append_new", ["code_iris", "annee"]),
    "silver/logements_sociaux": ("append_new", ["identifiant_livraison"]),
    "gold/indicateurs_dvf_iris": ("upsert", ["code_iris", "annee"]),
    "gold/indicateurs_socio_eco_iris": ("upsert", ["code_iris", "annee"]),
    "gold/indicateurs_logements_sociaux_iris": ("upsert", ["code_iris", "annee"]),
    "gold/score_environnemental": ("upsert", ["code_iris"]),
    "gold/indicateurs_mobilite_iris": ("upsert", ["code_iris"]),
    "silver/elementaires_maternelles_effectifs": ("insert_ignore", ["numero_ecole"]),
    "silver/colleges_paris": ("insert_ignore", ["id"]),
    "silver/map_sante": ("insert_ignore", ["finess"]),
    "silver/population_totale_paris": ("insert_if_empty", []),
    "silver/population_enfants_paris": ("insert_if_empty", []),
    "silver/sante_paris": ("insert_if_empty", []),
    "silver/map_scolaire": ("insert_ignore", ["id"]),
    "silver/population_iris": ("insert_if_empty", []),
    "gold/indicateurs_aes_arrondissement": ("upsert", ["arrondissement"]),
    "silver/reseau_mobile": ("insert_if_empty", []),
    "silver/reseau_fibre": ("insert_if_empty", []),
    "silver/reseau_qualite": ("insert_if_empty", []),
    "gold/score_reseau": ("insert_if_empty", []),
    "serving/zone_indicators": ("replace", []),
    "serving/district_indicators": ("replace", []),
    "serving/zone_features": ("replace", []),
    "serving/district_features": ("replace", []),
}


# Tables read by year are dealt over partitions by it.
YEARLY = ["gold/indicateurs_dvf_iris", "gold/indicateurs_socio_eco_iris", "gold/indicateurs_logements_sociaux_iris"]


def load_table(spark: SparkSession, warehouse: str, name: str, df: DataFrame, ctx: dict | None = None) -> DataFrame:
    """Load a batch by the table's rule and contract and return the table's rows;
    rejected rows go to ``rejected/<name>``, the load's measures to
    ``ctx["metrics"][name]``."""
    rule, keys = TABLE_RULES[name]
    layout = L.Layout(keys, by="annee" if name in YEARLY else None)
    done = L.load(df, os.path.join(warehouse, name), rule, keys, contracts.DECLARED.get(name), layout,
                  os.path.join(warehouse, "rejected", name))
    if ctx is not None:
        ctx.setdefault("metrics", {})[name] = done.metrics
    return done.table


def default_steps(paths: dict[str, str], warehouse: str, cell: float) -> dict[str, list[tuple[str, Step]]]:
    """Steps for the housing, environment and mobility domains and the zone
    table from landing files named in ``paths`` (keys: ``zones``, ``sales``
    and ``income`` — comma-separated file lists —, ``addresses``,
    ``social_housing``, ``trees``, ``green_spaces``, ``cool_islands``,
    ``sorting_stations``, ``stops``, ``rail_stations``, ``bike_stations``,
    ``school_headcounts``, ``schools``, ``colleges``, ``hospitals``,
    ``district_population``, ``zone_population``, ``age_structure``,
    ``health_equipment``, ``coverage`` — comma-separated layer files —,
    ``antennas``, ``fibre``, ``qos``, ``districts``);
    datasets without a path are skipped.  Zone geometry is parsed once and
    kept as tables in ``ctx``.  Rows that the stored tables already have are left
    out before they are attached to zones."""
    from ..sources import geojson as GJ
    from ..sources import readers as R
    from ..functions import clean as C
    from ..functions.geo import project_edges
    from ..operators import spatial as G
    from . import education as ED
    from . import network as NET
    from . import environment as ENV
    from . import housing as H
    from . import mobility as MOB
    from . import serving as SV

    def zones(spark, ctx):
        z = GJ.read_zones(spark, paths["zones"])
        zp, ep = GJ.write_zone_tables(z, os.path.join(warehouse, "ref"))
        ctx["zones"], ctx["edges"] = spark.read.parquet(zp), spark.read.parquet(ep)

    def read(spark, name, **kw):
        return R.read_source(spark, name, paths[name], **kw)

    def stored(spark, name):
        return L.read_current(spark, os.path.join(warehouse, name))

    def env_silver(spark, ctx):
        e, z = ctx["edges"], ctx["zones"]
        if "trees" in paths:
            ctx["trees"] = load_table(spark, warehouse, "silver/arbres",
                                      ENV.trees_silver(read(spark, "trees"), e, z, stored(spark, "silver/arbres")), ctx)
        if "green_spaces" in paths:
            ctx["green"] = load_table(spark, warehouse, "silver/espaces_verts",
                                      ENV.green_spaces_silver(read(spark, "green_spaces"), e, cell,
                                                              stored(spark, "silver/espaces_verts")), ctx)
        if "cool_islands" in paths:
            ctx["islands"] = load_table(spark, warehouse, "silver/ilots_fraicheur",
                                        ENV.cool_islands_silver(read(spark, "cool_islands", with_position=True), e, cell,
                                                                stored(spark, "silver/ilots_fraicheur")), ctx)
        if "sorting_stations" in paths:
            ctx["stations_tri"] = load_table(spark, warehouse, "silver/trilib",
                                             ENV.sorting_stations_silver(read(spark, "sorting_stations"), e, cell,
                                                                         stored(spark, "silver/trilib")), ctx)

    def mob_silver(spark, ctx):
        e, z = ctx["edges"], ctx["zones"]
        for key, name, fn, out in [("stops", "silver/map_arrets", MOB.stops_silver, "stops"),
                                   ("rail_stations", "silver/map_gares", MOB.stations_silver, "stations"),
                                   ("bike_stations", "silver/map_velib", MOB.bikes_silver, "bikes")]:
            if key in paths:
                ctx[out] = load_table(spark, warehouse, name,
                                      fn(read(spark, key, with_position=True), e, z, stored(spark, name)), ctx)

    def housing_silver(spark, ctx):
        e, z = ctx["edges"], ctx["zones"]
        if "sales" in paths:
            raw = R.read_delimited(spark, paths["sales"].split(","), R.SOURCES["sales"], with_position=True)
            addr = R.read_delimited(spark, paths["addresses"], R.ReaderSpec(sep=";")) \
                .withColumn("latitude", F.col("latitude").cast("double")) \
                .withColumn("longitude", F.col("longitude").cast("double")) if "addresses" in paths else None
            ctx["sales"] = load_table(
                spark, warehouse, "silver/dvf",
                H.sales_silver(raw, addr, e, z, stored(spark, "silver/dvf")), ctx)
        if "income" in paths:
            yearly = R.read_yearly(spark, paths["income"].split(","), R.SOURCES["income"], "DISP_MED", "IRIS")
            ctx["income"] = load_table(spark, warehouse, "silver/filosofi", H.income_silver(yearly), ctx)
        if "social_housing" in paths:
            ctx["social"] = load_table(spark, warehouse, "silver/logements_sociaux",
                                       H.social_housing_silver(read(spark, "social_housing", with_position=True), e, z,
                                                               stored(spark, "silver/logements_sociaux")), ctx)

    def housing_gold(spark, ctx):
        # price indicators (DP2) before the affordability index (DP4) that reads them
        if "sales" in ctx:
            ctx["prices"] = load_table(spark, warehouse, "gold/indicateurs_dvf_iris", H.price_indicators(ctx["sales"]), ctx)
        if "prices" in ctx and "income" in ctx:
            ctx["socio"] = load_table(spark, warehouse, "gold/indicateurs_socio_eco_iris",
                                      H.affordability(ctx["income"], ctx["prices"]), ctx)
        if "social" in ctx:
            ctx["housing"] = load_table(spark, warehouse, "gold/indicateurs_logements_sociaux_iris",
                                        H.social_housing_gold(ctx["social"]), ctx)

    def education_silver(spark, ctx):
        e, z = ctx["edges"], ctx["zones"]
        if "school_headcounts" in paths:
            ctx["pupils"] = load_table(spark, warehouse, "silver/elementaires_maternelles_effectifs",
                                       ED.headcounts_silver(read(spark, "school_headcounts", with_position=True)), ctx)
        if "colleges" in paths:
            ctx["colleges"] = load_table(spark, warehouse, "silver/colleges_paris",
                                         ED.colleges_silver(read(spark, "colleges", with_position=True), e, z), ctx)
        if "schools" in paths and "colleges" in paths:
            ctx["schools"] = load_table(spark, warehouse, "silver/map_scolaire", ED.schools_map(
                read(spark, "schools", with_position=True), read(spark, "colleges", with_position=True), e, z), ctx)
        if "hospitals" in paths:
            ctx["hospitals"] = load_table(spark, warehouse, "silver/map_sante",
                                          ED.hospitals_silver(read(spark, "hospitals", with_position=True), e, z), ctx)
        if "district_population" in paths:
            ctx["population"] = load_table(spark, warehouse, "silver/population_totale_paris",
                                           ED.district_population(read(spark, "district_population")), ctx)
        if "zone_population" in paths:
            ctx["zone_population"] = load_table(spark, warehouse, "silver/population_iris",
                                                ED.zone_population(read(spark, "zone_population")), ctx)
        if "age_structure" in paths:
            ctx["children"] = load_table(spark, warehouse, "silver/population_enfants_paris",
                                         ED.age_population(read(spark, "age_structure")), ctx)
        if "health_equipment" in paths:
            ctx["health"] = load_table(spark, warehouse, "silver/sante_paris",
                                       ED.health_equipment(read(spark, "health_equipment")), ctx)

    def education_gold(spark, ctx):
        needed = ["pupils", "colleges", "children", "population", "health", "hospitals"]
        if all(k in ctx for k in needed):
            ctx["aes"] = load_table(spark, warehouse, "gold/indicateurs_aes_arrondissement",
                                    ED.aes_scores(*[ctx[k] for k in needed]), ctx)

    def network_silver(spark, ctx):
        z = ctx["zones"]
        z93 = project_edges(ctx["edges"])
        cell_m = G.auto_cell_size(z93)
        ctx["cell_m"] = cell_m
        if "coverage" in paths:
            layers = materialize(GJ.read_coverage_layers(spark, paths["coverage"].split(",")))
            attrs = layers.select("id", C.map_values("op_code", C.COVERAGE_OPERATOR_CODES, passthrough=True)
                                  .alias("operateur"), "techno", "niveau")
            cov_edges = project_edges(G.polygon_edges(layers, "id", "coords"))
            names = {R.coverage_layer(p, C.COVERAGE_OPERATOR_CODES) for p in paths["coverage"].split(",")}
            cov = NET.coverage_rates(cov_edges, attrs, z93, z, cell_m, layers=sorted(names))
            area = G.polygon_area(z93).select(F.col("id").alias("zone"), "area")
            density = NET.antenna_density(read(spark, "antennas"), z, area) if "antennas" in paths else \
                spark.createDataFrame([], "code_iris string, operateur string, nb_antennes double, "
                                          "densite_antennes_km2 double, score_densite double")
            ctx["mobile"] = load_table(spark, warehouse, "silver/reseau_mobile", NET.mobile_silver(cov, density, z), ctx)
        if "fibre" in paths:
            ctx["fibre"] = load_table(spark, warehouse, "silver/reseau_fibre", NET.fibre_silver(
                NET.fibre_buildings(read(spark, "fibre"), z93, z, cell_m)), ctx)
        if "qos" in paths:
            ctx["quality"] = load_table(spark, warehouse, "silver/reseau_qualite", NET.quality_silver(
                NET.qos_measures(read(spark, "qos"), z93, z, cell_m)), ctx)

    def network_gold(spark, ctx):
        if "mobile" not in ctx:
            return
        quality = ctx.get("quality", empty(spark, "code_iris string, score_qualite double"))
        fibre = ctx.get("fibre", empty(spark, "code_iris string, taux_deploiement double, taux_pm_actif double, "
                                              "score_fibre double, meilleur_operateur_fibre string"))
        neigh = G.adjacency(ctx["edges"], G.auto_cell_size(ctx["edges"]))
        ctx["net"] = load_table(spark, warehouse, "gold/score_reseau",
                                NET.network_score(ctx["mobile"], quality, fibre, ctx["zones"], neigh), ctx)

    def empty(spark, schema):
        return spark.createDataFrame([], schema)

    def gold(spark, ctx):
        z = ctx["zones"]
        ids = "id string, code_iris string"
        ctx["env"] = load_table(spark, warehouse, "gold/score_environnemental", ENV.environment_score(
            z, ctx.get("trees", empty(spark, ids)),
            ctx.get("green", empty(spark, "id string, code_iris string, superficie double")),
            ctx.get("islands", empty(spark, ids)), ctx.get("stations_tri", empty(spark, ids))), ctx)
        ctx["mob"] = load_table(spark, warehouse, "gold/indicateurs_mobilite_iris", MOB.mobility_score(
            z, ctx.get("stops", empty(spark, "code_iris string, type string")),
            ctx.get("stations", empty(spark, "code_iris string, mode string")),
            ctx.get("bikes", empty(spark, "code_iris string, capacite int"))), ctx)

    def serve(spark, ctx):
        e = empty
        ctx["zone_indicators"] = load_table(spark, warehouse, "serving/zone_indicators", SV.zone_indicators(
            ctx["zones"], ctx.get("housing", e(spark, "code_iris string, annee int, nb_logements_sociaux_finances int")),
            ctx.get("socio", e(spark, "code_iris string, annee int, revenu_median double, prix_m2_median double, iai double")),
            ctx["env"], ctx.get("net", e(spark, "code_iris string, score_final_stocke double, "
                                                "meilleur_operateur_mobile string, meilleur_operateur_fibre string")),
            ctx["mob"], ctx.get("year", 2025)), ctx)
        ctx["zone_features"] = load_table(spark, warehouse, "serving/zone_features", SV.features(ctx["zones"]), ctx)
        if "districts" in paths:
            ctx["district_features"] = load_table(spark, warehouse, "serving/district_features",
                                                  SV.district_features(GJ.read_districts(spark, paths["districts"])), ctx)
        if "aes" in ctx:
            ctx["district_indicators"] = load_table(spark, warehouse, "serving/district_indicators",
                                                    SV.district_indicators(ctx["zone_indicators"], ctx["aes"]), ctx)

    return {"silver": [("zones", zones), ("housing", housing_silver), ("environment", env_silver),
                       ("mobility", mob_silver), ("education", education_silver), ("network", network_silver)],
            "gold": [("housing", housing_gold), ("scores", gold), ("education", education_gold),
                     ("network", network_gold)],
            "serving": [("zone_indicators", serve)]}
