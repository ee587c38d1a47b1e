"""Housing and income (DP1–DP5): property sales, price indicators, income,
affordability index, social housing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from ..operators import load as L
from ..operators import score as S
from ..operators import temporal as TM
from .common import attach_zone, carried, first_in_file, unseen

# Raw sales columns kept and their silver names.
SALES_COLUMNS = {
    "No disposition": "no_disposition", "Date mutation": "date_mutation",
    "Nature mutation": "nature_mutation", "Valeur fonciere": "valeur_fonciere",
    "No voie": "no_voie", "Type de voie": "type_voie", "Voie": "voie",
    "Code postal": "code_postal", "Commune": "commune", "Code departement": "code_departement",
    "Code commune": "code_commune", "Section": "section", "No plan": "no_plan",
    "Code type local": "code_type_local", "Type local": "type_local",
    "Surface reelle bati": "surface_reelle_bati", "Nombre pieces principales": "nombre_pieces",
    "Surface terrain": "surface_terrain",
}
# The ten columns hashed into the sale id, in order.
SALE_ID_COLUMNS = ["date_mutation", "no_disposition", "code_commune", "section", "no_plan", "no_voie", "voie",
                   "code_type_local", "surface_reelle_bati", "nombre_pieces"]


def sales_silver(raw: DataFrame, addresses: DataFrame | None = None,
                 zone_edges: DataFrame | None = None, zones: DataFrame | None = None,
                 target: DataFrame | None = None) -> DataFrame:
    """DP1: Paris flats and houses, parsed, id'd, the first row of the files per
    id, new ids only, geocoded by the address reference (JN17) and attached to
    zones (JN1)."""
    df = raw.select(*[F.col(k).alias(v) for k, v in SALES_COLUMNS.items() if k in raw.columns], *carried(raw))
    df = df.filter((F.col("code_departement") == "75") & F.col("code_type_local").isin("1", "2"))
    df = df.withColumns({
        "valeur_fonciere": C.comma_decimal("valeur_fonciere"),
        "date_mutation": C.parse_date("date_mutation"),
        "surface_reelle_bati": C.to_int("surface_reelle_bati"),
        "nombre_pieces": C.to_int("nombre_pieces"),
        "surface_terrain": C.to_int("surface_terrain"),
        "arrondissement": C.to_int("code_commune").cast("int"),
    })
    df = df.withColumn("id_mutation", C.row_id(*SALE_ID_COLUMNS))
    df = first_in_file(unseen(df, target, ["id_mutation"]), ["id_mutation"], ["date_mutation"])
    if addresses is not None:
        adresse = F.trim(F.concat_ws(" ", F.coalesce("no_voie", F.lit("")), F.coalesce("type_voie", F.lit("")),
                                     F.coalesce("voie", F.lit(""))))
        df = df.withColumn("adresse", adresse)
        ref = addresses.select("adresse", F.col("postcode").alias("code_postal"),
                               F.col("latitude"), F.col("longitude"))
        point = F.struct("latitude", "longitude")
        ref = ref.groupBy("adresse", "code_postal").agg(F.min(point).alias("p")) \
                 .select("adresse", "code_postal", "p.latitude", "p.longitude")
        usable = F.length("adresse") > 2
        df = df.join(ref, ["adresse", "code_postal"], "left") \
               .withColumn("latitude", F.when(usable, F.col("latitude"))) \
               .withColumn("longitude", F.when(usable, F.col("longitude"))).drop("adresse")
    if zone_edges is not None and zones is not None and "latitude" in df.columns:
        df = attach_zone(df.withColumnRenamed("arrondissement", "_arr"), zone_edges, zones,
                         "latitude", "longitude").drop("nom_iris", "arrondissement") \
            .withColumnRenamed("_arr", "arrondissement")
    return df.drop("code_type_local", "no_disposition")


def price_indicators(sales: DataFrame) -> DataFrame:
    """DP2: price per m² per (zone, year, district): count, exact median and
    mean (round 2), flats and houses."""
    s = C.positive(sales, "valeur_fonciere", "surface_reelle_bati")
    s = s.withColumn("prix_m2", F.col("valeur_fonciere") / F.col("surface_reelle_bati")) \
         .withColumn("annee", F.year("date_mutation"))
    keys = ["code_iris", "annee", "arrondissement"]
    s = A.drop_null_keys(s, keys)
    base = s.groupBy(*keys).agg(
        F.count("*").alias("nb_transactions"),
        C.round_dec(F.avg("prix_m2"), 2).alias("prix_m2_moyen"),
        A.count_filter(F.col("type_local") == "Appartement").alias("nb_appartements"),
        A.count_filter(F.col("type_local") == "Maison").alias("nb_maisons"))
    med = A.exact_median(s, keys, "prix_m2", "_m")
    return base.join(med, keys).withColumn("prix_m2_median", C.round_dec("_m", 2)).drop("_m")


def income_silver(yearly: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """DP3: ``(zone, year, raw value)`` -> Paris zones, numeric median income,
    district from the zone code; only new (zone, year) pairs."""
    df = yearly.filter(F.col("IRIS").startswith("751")).select(
        F.col("IRIS").alias("code_iris"), "annee", C.comma_decimal("value").alias("revenu_median"),
        C.code_to_district("IRIS", "zone").alias("arrondissement"))
    return L.new_rows(target, df, ["code_iris", "annee"]) if target is not None else df


def affordability(income: DataFrame, prices: DataFrame) -> DataFrame:
    """DP4: iai = round(price_m2_median / (income / 12), 4) on the exact
    (zone, year) join, nearest-year fallback only when it is empty."""
    j = TM.exact_or_nearest(income.select("code_iris", "annee", "revenu_median", "arrondissement"),
                            prices.select("code_iris", "annee", "prix_m2_median"), ["code_iris"], "annee")
    j = j.filter(F.col("revenu_median").isNotNull() & F.col("prix_m2_median").isNotNull())
    return j.withColumn("iai", C.round_dec(F.col("prix_m2_median") / (F.col("revenu_median") / 12.0), 4))


SOCIAL_COUNTS = ["nb_logements_finances", "nb_plai", "nb_plus", "nb_plus_cd", "nb_pls"]
# Raw social-housing columns and their silver names.
SOCIAL_COLUMNS = {
    "Identifiant livraison": "identifiant_livraison", "Adresse du programme": "adresse",
    "Code postal": "code_postal", "Ville": "ville",
    "Année du financement - agrément": "annee_financement", "Bailleur social": "bailleur_social",
    "Nombre total de logements financés": "nb_logements_finances",
    "Dont nombre de logements PLA I": "nb_plai", "Dont nombre de logements PLUS": "nb_plus",
    "Dont nombre de logements PLUS CD": "nb_plus_cd", "Dont nombre de logements PLS": "nb_pls",
    "Mode de réalisation": "mode_realisation", "Commentaires": "commentaires",
    "Arrondissement": "arrondissement", "Nature de programme": "nature_programme",
    "Coordonnée en X (L93)": "x_l93", "Coordonnée en Y (L93)": "y_l93",
    "geo_shape": "geo_shape", "geo_point_2d": "geo_point_2d",
}


def social_housing_silver(raw: DataFrame, zone_edges: DataFrame, zones: DataFrame,
                          target: DataFrame | None = None) -> DataFrame:
    """DP5 silver: renamed columns, ``"lat, lon"`` split on comma-space,
    integer counts, only ids new to the target, first row of the file per
    delivery id, zone attached (rows without coordinates kept with a NULL zone)."""
    # absent optional columns become NULL strings so the silver schema is stable
    df = raw.select(*[(F.col(k) if k in raw.columns else F.lit(None).cast("string")).alias(v)
                      for k, v in SOCIAL_COLUMNS.items()], *carried(raw))
    lat, lon = C.lat_lon("geo_point_2d", sep=", ")
    df = df.withColumns({"latitude": lat, "longitude": lon,
                         "annee_financement": C.to_int("annee_financement").cast("int"),
                         "arrondissement": C.to_int("arrondissement").cast("int"),
                         "x_l93": C.to_number("x_l93"), "y_l93": C.to_number("y_l93"),
                         **{c: C.to_int(c).cast("int") for c in SOCIAL_COUNTS}}) \
           .drop("geo_point_2d", "geo_shape")
    df = first_in_file(unseen(df, target, ["identifiant_livraison"]), ["identifiant_livraison"], ["adresse"])
    return attach_zone(df.withColumnRenamed("arrondissement", "_arr"), zone_edges, zones,
                       "latitude", "longitude").drop("nom_iris", "arrondissement") \
        .withColumnRenamed("_arr", "arrondissement")


def social_housing_gold(silver: DataFrame) -> DataFrame:
    """DP5 gold: financed housing sums per (zone, year, district), 0 when absent."""
    keys = ["code_iris", "annee_financement", "arrondissement"]
    g = A.drop_null_keys(silver, keys).groupBy(*keys).agg(
        *[A.sum_or_zero(c).alias(c if c != "nb_logements_finances" else "nb_logements_sociaux_finances")
          for c in SOCIAL_COUNTS])
    return g.withColumnRenamed("annee_financement", "annee")
