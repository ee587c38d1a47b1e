"""Contracts of the stored tables (SNK12): columns, types, keys, defaults.

Surrogate keys and the load timestamp (SNK14) are left out: they come with the
load, not with the data.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import load as L

# The declared tables.
DECLARED = {
    "silver/colleges_paris": L.Contract(
        columns={"id": "varchar(300)", "nom": "varchar(255)", "adresse": "varchar(255)", "arrondissement": "smallint",
                 "lat": "double", "lon": "double", "code_iris": "int", "nom_iris": "varchar(255)"},
        primary_key=["id"],
        not_null=["nom", "arrondissement"]),
    "silver/elementaires_maternelles_effectifs": L.Contract(
        columns={"numero_ecole": "varchar(20)", "nom": "varchar(255)", "type": "varchar(100)",
                 "secteur": "varchar(50)", "arrondissement": "smallint", "nb_eleves": "int"},
        not_null=["numero_ecole", "arrondissement", "nb_eleves"],
        unique=[["numero_ecole"]]),
    "silver/map_sante": L.Contract(
        columns={"finess": "varchar(20)", "nom": "varchar(255)", "adresse": "varchar(255)",
                 "telephone": "varchar(20)", "categorie": "varchar(150)", "type_etablissement": "varchar(150)",
                 "cp_ville": "varchar(50)", "arrondissement": "smallint", "lat": "double", "lon": "double",
                 "code_iris": "int", "nom_iris": "varchar(255)"},
        not_null=["finess", "nom", "arrondissement"],
        unique=[["finess"]]),
    "silver/map_scolaire": L.Contract(
        columns={"id": "varchar(300)", "nom": "varchar(255)", "adresse": "varchar(255)", "type": "varchar(50)",
                 "arrondissement": "smallint", "lat": "double", "lon": "double", "code_iris": "int",
                 "nom_iris": "varchar(255)"},
        primary_key=["id"],
        not_null=["nom", "type", "arrondissement"]),
    "silver/population_enfants_paris": L.Contract(
        columns={"arrondissement": "smallint", "pop_3_10": "int", "pop_11_17": "int"},
        not_null=["arrondissement", "pop_3_10", "pop_11_17"]),
    "silver/population_totale_paris": L.Contract(
        columns={"arrondissement": "smallint", "population_totale": "int"},
        not_null=["arrondissement", "population_totale"]),
    "silver/population_iris": L.Contract(
        columns={"code_iris": "string", "arrondissement": "smallint", "pop_totale": "double", "pop_3_10": "double",
                 "pop_11_17": "double"},
        primary_key=["code_iris"],
        not_null=["arrondissement", "pop_totale", "pop_3_10", "pop_11_17"]),
    "silver/sante_paris": L.Contract(
        columns={"arrondissement": "smallint", "nb_medecins": "int", "nb_infirmiers": "int",
                 "nb_centres_sante": "int", "nb_pharmacies": "int"},
        not_null=["arrondissement", "nb_medecins", "nb_infirmiers", "nb_centres_sante", "nb_pharmacies"],
        defaults={"nb_medecins": 0, "nb_infirmiers": 0, "nb_centres_sante": 0, "nb_pharmacies": 0}),
    "silver/arbres": L.Contract(
        columns={"id": "int", "arrondissement": "int", "latitude": "double", "longitude": "double",
                 "code_iris": "string"},
        primary_key=["id"]),
    "silver/espaces_verts": L.Contract(
        columns={"id": "int", "nom": "string", "code_postal": "int", "superficie": "double", "annee": "int",
                 "geo_shape": "string", "code_iris": "string"},
        primary_key=["id", "code_iris"]),
    "silver/ilots_fraicheur": L.Contract(
        columns={"id": "string", "nom": "string", "code_postal": "int", "geo_shape": "string", "code_iris": "string"},
        primary_key=["id", "code_postal"]),
    "silver/trilib": L.Contract(
        columns={"id": "int", "arrondissement": "int", "geo_shape": "string", "code_iris": "string"},
        primary_key=["id"]),
    "silver/dvf": L.Contract(
        columns={"id_mutation": "string", "date_mutation": "date", "nature_mutation": "string",
                 "valeur_fonciere": "double", "no_voie": "string", "type_voie": "string", "voie": "string",
                 "code_postal": "string", "commune": "string", "code_departement": "string", "code_commune": "string",
                 "arrondissement": "int", "section": "string", "no_plan": "string", "type_local": "string",
                 "surface_reelle_bati": "int", "nombre_pieces": "int", "surface_terrain": "int", "latitude": "double",
                 "longitude": "double", "code_iris": "string"},
        primary_key=["id_mutation"]),
    "silver/filosofi": L.Contract(
        columns={"code_iris": "string", "annee": "int", "revenu_median": "double", "arrondissement": "int"},
        primary_key=["code_iris", "annee"]),
    "silver/logements_sociaux": L.Contract(
        columns={"identifiant_livraison": "string", "adresse": "string", "code_postal": "string", "ville": "string",
                 "annee_financement": "int", "bailleur_social": "string", "nb_logements_finances": "int",
                 "nb_plai": "int", "nb_plus": "int", "nb_plus_cd": "int", "nb_pls": "int",
                 "mode_realisation": "string", "commentaires": "string", "arrondissement": "int",
                 "nature_programme": "string", "x_l93": "double", "y_l93": "double", "latitude": "double",
                 "longitude": "double", "code_iris": "string"},
        primary_key=["identifiant_livraison"]),
    "silver/map_arrets": L.Contract(
        columns={"arret_id": "int", "nom": "varchar(255)", "type": "varchar(50)", "lat": "double", "lon": "double",
                 "code_iris": "int", "nom_iris": "varchar(255)", "arrondissement": "int"},
        primary_key=["arret_id"],
        not_null=["nom"]),
    "silver/map_gares": L.Contract(
        columns={"gare_id": "int", "nom": "varchar(255)", "mode": "varchar(50)", "ligne": "varchar(100)",
                 "exploitant": "varchar(100)", "lat": "double", "lon": "double", "code_iris": "int",
                 "nom_iris": "varchar(255)", "arrondissement": "int"},
        primary_key=["gare_id"],
        not_null=["nom"]),
    "silver/map_velib": L.Contract(
        columns={"station_id": "varchar(20)", "nom": "varchar(255)", "capacite": "int", "lat": "double",
                 "lon": "double", "code_iris": "int", "nom_iris": "varchar(255)", "arrondissement": "int"},
        primary_key=["station_id"],
        not_null=["nom"]),
    "silver/reseau_fibre": L.Contract(
        columns={"code_iris": "varchar(9)", "arrondissement": "smallint", "total_imb": "int", "imb_deployes": "int",
                 "pm_actifs": "int", "taux_deploiement": "decimal(5,2)", "taux_pm_actif": "decimal(5,2)",
                 "meilleur_operateur_fibre": "varchar(20)", "score_fibre": "decimal(5,2)"},
        not_null=["code_iris", "arrondissement", "total_imb", "imb_deployes", "pm_actifs", "taux_deploiement",
                  "taux_pm_actif", "score_fibre"],
        unique=[["code_iris"]]),
    "silver/reseau_mobile": L.Contract(
        columns={"code_iris": "varchar(9)", "arrondissement": "smallint", "operateur": "varchar(20)",
                 "couv_4g": "decimal(5,2)", "couv_5g": "decimal(5,2)", "score_niveau": "smallint",
                 "nb_antennes": "int", "densite_antennes_km2": "decimal(8,3)", "score_densite": "decimal(5,2)",
                 "score_mobile": "decimal(5,2)"},
        not_null=["code_iris", "arrondissement", "operateur"]),
    "silver/reseau_qualite": L.Contract(
        columns={"code_iris": "varchar(9)", "arrondissement": "smallint", "operateur": "varchar(20)",
                 "score_debit": "decimal(5,2)", "score_fiabilite": "decimal(5,2)", "score_latence": "decimal(5,2)",
                 "score_qualite": "decimal(5,2)"},
        not_null=["code_iris", "arrondissement", "operateur"]),
    "gold/indicateurs_dvf_iris": L.Contract(
        columns={"code_iris": "string", "annee": "int", "arrondissement": "int", "nb_transactions": "int",
                 "prix_m2_median": "double", "prix_m2_moyen": "double", "nb_appartements": "int",
                 "nb_maisons": "int"},
        primary_key=["code_iris", "annee"]),
    "gold/indicateurs_logements_sociaux_iris": L.Contract(
        columns={"code_iris": "string", "annee": "int", "arrondissement": "int",
                 "nb_logements_sociaux_finances": "int", "nb_plai": "int", "nb_plus": "int", "nb_plus_cd": "int",
                 "nb_pls": "int"},
        primary_key=["code_iris", "annee"]),
    "gold/indicateurs_socio_eco_iris": L.Contract(
        columns={"code_iris": "string", "annee": "int", "arrondissement": "int", "revenu_median": "double",
                 "prix_m2_median": "double", "iai": "double"},
        primary_key=["code_iris", "annee"]),
    "gold/score_environnemental": L.Contract(
        columns={"code_iris": "string", "arrondissement": "int", "score": "double"},
        primary_key=["code_iris"]),
    "gold/indicateurs_aes_arrondissement": L.Contract(
        columns={"arrondissement": "smallint", "e1_scolarisation": "double", "e2_couverture_college": "double",
                 "s1_medecins": "double", "s2_infirmiers": "double", "s3_centres_hospitaliers": "double",
                 "s4_pharmacies": "double", "score_education": "double", "score_sante": "double",
                 "score_aes": "double"},
        primary_key=["arrondissement"]),
    "gold/indicateurs_mobilite_iris": L.Contract(
        columns={"code_iris": "varchar(9)", "arrondissement": "smallint", "nb_arrets_bus": "int",
                 "nb_gares_metro": "int", "nb_gares_rer": "int", "nb_gares_train": "int", "nb_gares_tramway": "int",
                 "nb_stations_velib": "int", "capacite_velib": "int", "norm_arrets_bus": "double",
                 "norm_gares_metro": "double", "norm_gares_rer": "double", "norm_gares_train": "double",
                 "norm_gares_tramway": "double", "norm_stations_velib": "double", "norm_capacite_velib": "double",
                 "score_transport_collectif": "double", "score_velib": "double", "score_mobilite": "double",
                 "rang_mobilite": "int"},
        primary_key=["code_iris"],
        not_null=["arrondissement", "nb_arrets_bus", "nb_gares_metro", "nb_gares_rer", "nb_gares_train",
                  "nb_gares_tramway", "nb_stations_velib", "capacite_velib", "norm_arrets_bus", "norm_gares_metro",
                  "norm_gares_rer", "norm_gares_train", "norm_gares_tramway", "norm_stations_velib",
                  "norm_capacite_velib", "score_transport_collectif", "score_velib", "score_mobilite",
                  "rang_mobilite"],
        defaults={"nb_arrets_bus": 0, "nb_gares_metro": 0, "nb_gares_rer": 0, "nb_gares_train": 0,
                  "nb_gares_tramway": 0, "nb_stations_velib": 0, "capacite_velib": 0}),
    "gold/score_reseau": L.Contract(
        columns={"code_iris": "varchar(9)", "arrondissement": "smallint", "rang_reseau": "smallint",
                 "score_final": "decimal(5,2)", "score_mobile": "decimal(5,2)", "score_qualite": "decimal(5,2)",
                 "score_fibre": "decimal(5,2)", "couv_4g_max": "decimal(5,2)", "couv_5g_max": "decimal(5,2)",
                 "taux_deploiement_fibre": "decimal(5,2)", "taux_pm_actif": "decimal(5,2)",
                 "meilleur_operateur_mobile": "varchar(20)", "meilleur_operateur_fibre": "varchar(20)"},
        not_null=["code_iris", "arrondissement", "rang_reseau", "score_final"],
        unique=[["code_iris"]]),
}


def check(name: str, df: DataFrame) -> DataFrame:
    """``(rule, column, n)`` violations of the table's contract; a declared
    column that ``df`` doesn't have is one violation of the rule ``missing``."""
    contract = DECLARED[name]
    have = lambda cols: [c for c in cols if c in df.columns]
    found = L.violations(df, L.Contract(
        columns={c: t for c, t in contract.columns.items() if c in df.columns}, primary_key=have(contract.primary_key),
        unique=[u for u in contract.unique if have(u) == u], not_null=have(contract.not_null)))
    missing = [(c,) for c in contract.columns if c not in df.columns]
    gaps = df.sparkSession.createDataFrame(missing, "column string").select(
        F.lit("missing").alias("rule"), "column", F.lit(1).cast("long").alias("n"))
    return found.unionByName(gaps)


def report(spark: SparkSession, warehouse: str) -> DataFrame:
    """``(table, rule, column, n)`` with ``n > 0`` over all stored tables."""
    out = spark.createDataFrame([], "table string, rule string, column string, n long")
    for name in DECLARED:
        df = L.read_current(spark, os.path.join(warehouse, name))
        if df is not None:
            out = out.unionByName(check(name, df).filter("n > 0").select(F.lit(name).alias("table"), "rule", "column", "n"))
    return out
