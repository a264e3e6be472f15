"""Reference dimensions: geography, regions, equipment and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Department code, name, reference city, latitude, longitude, region, elevation (m).
DEPARTMENT_ROWS = [
    ("01", "Ain", "Bourg-en-Bresse", 46.21, 5.23, "84", 224.0),
    ("02", "Aisne", "Laon", 49.56, 3.62, "32", 82.0),
    ("03", "Allier", "Moulins", 46.57, 3.33, "84", 242.0),
    ("04", "Alpes-de-Haute-Provence", "Digne-les-Bains", 44.09, 6.24, "93", 608.0),
    ("05", "Hautes-Alpes", "Gap", 44.56, 6.08, "93", 735.0),
    ("06", "Alpes-Maritimes", "Nice", 43.7, 7.27, "93", 10.0),
    ("07", "Ardeche", "Privas", 44.74, 4.6, "84", 300.0),
    ("08", "Ardennes", "Charleville-Mezieres", 49.77, 4.72, "44", 160.0),
    ("09", "Ariege", "Foix", 42.97, 1.61, "76", 390.0),
    ("10", "Aube", "Troyes", 48.3, 4.07, "44", 113.0),
    ("11", "Aude", "Carcassonne", 43.21, 2.35, "76", 111.0),
    ("12", "Aveyron", "Rodez", 44.35, 2.57, "76", 635.0),
    ("13", "Bouches-du-Rhone", "Marseille", 43.3, 5.37, "93", 12.0),
    ("14", "Calvados", "Caen", 49.18, -0.37, "28", 25.0),
    ("15", "Cantal", "Aurillac", 44.93, 2.44, "84", 631.0),
    ("16", "Charente", "Angouleme", 45.65, 0.16, "75", 100.0),
    ("17", "Charente-Maritime", "La Rochelle", 46.16, -1.15, "75", 8.0),
    ("18", "Cher", "Bourges", 47.08, 2.4, "24", 153.0),
    ("19", "Correze", "Tulle", 45.27, 1.77, "75", 455.0),
    ("21", "Cote-d'Or", "Dijon", 47.32, 5.04, "27", 245.0),
    ("22", "Cotes-d'Armor", "Saint-Brieuc", 48.51, -2.76, "53", 135.0),
    ("23", "Creuse", "Gueret", 46.17, 1.87, "75", 457.0),
    ("24", "Dordogne", "Perigueux", 45.19, 0.72, "75", 86.0),
    ("25", "Doubs", "Besancon", 47.24, 6.02, "27", 307.0),
    ("26", "Drome", "Valence", 44.93, 4.89, "84", 126.0),
    ("27", "Eure", "Evreux", 49.02, 1.15, "28", 64.0),
    ("28", "Eure-et-Loir", "Chartres", 48.46, 1.5, "24", 142.0),
    ("29", "Finistere", "Quimper", 48.0, -4.1, "53", 63.0),
    ("2A", "Corse-du-Sud", "Ajaccio", 41.93, 8.74, "94", 18.0),
    ("2B", "Haute-Corse", "Bastia", 42.7, 9.45, "94", 5.0),
    ("30", "Gard", "Nimes", 43.84, 4.36, "76", 39.0),
    ("31", "Haute-Garonne", "Toulouse", 43.6, 1.44, "76", 141.0),
    ("32", "Gers", "Auch", 43.65, 0.59, "76", 169.0),
    ("33", "Gironde", "Bordeaux", 44.84, -0.58, "75", 6.0),
    ("34", "Herault", "Montpellier", 43.61, 3.88, "76", 27.0),
    ("35", "Ille-et-Vilaine", "Rennes", 48.11, -1.68, "53", 40.0),
    ("36", "Indre", "Chateauroux", 46.81, 1.69, "24", 155.0),
    ("37", "Indre-et-Loire", "Tours", 47.39, 0.69, "24", 60.0),
    ("38", "Isere", "Grenoble", 45.19, 5.72, "84", 212.0),
    ("39", "Jura", "Lons-le-Saunier", 46.67, 5.55, "27", 255.0),
    ("40", "Landes", "Mont-de-Marsan", 43.89, -0.5, "75", 60.0),
    ("41", "Loir-et-Cher", "Blois", 47.59, 1.33, "24", 73.0),
    ("42", "Loire", "Saint-Etienne", 45.44, 4.39, "84", 517.0),
    ("43", "Haute-Loire", "Le Puy-en-Velay", 45.04, 3.88, "84", 629.0),
    ("44", "Loire-Atlantique", "Nantes", 47.22, -1.55, "52", 8.0),
    ("45", "Loiret", "Orleans", 47.9, 1.9, "24", 116.0),
    ("46", "Lot", "Cahors", 44.45, 1.44, "76", 135.0),
    ("47", "Lot-et-Garonne", "Agen", 44.2, 0.62, "75", 50.0),
    ("48", "Lozere", "Mende", 44.52, 3.5, "76", 731.0),
    ("49", "Maine-et-Loire", "Angers", 47.47, -0.56, "52", 47.0),
    ("50", "Manche", "Saint-Lo", 49.12, -1.09, "28", 20.0),
    ("51", "Marne", "Chalons-en-Champagne", 48.96, 4.36, "44", 83.0),
    ("52", "Haute-Marne", "Chaumont", 48.11, 5.14, "44", 318.0),
    ("53", "Mayenne", "Laval", 48.07, -0.77, "52", 90.0),
    ("54", "Meurthe-et-Moselle", "Nancy", 48.69, 6.18, "44", 212.0),
    ("55", "Meuse", "Bar-le-Duc", 48.77, 5.16, "44", 188.0),
    ("56", "Morbihan", "Vannes", 47.66, -2.76, "53", 10.0),
    ("57", "Moselle", "Metz", 49.12, 6.18, "44", 178.0),
    ("58", "Nievre", "Nevers", 46.99, 3.16, "27", 194.0),
    ("59", "Nord", "Lille", 50.63, 3.06, "32", 20.0),
    ("60", "Oise", "Beauvais", 49.43, 2.08, "32", 67.0),
    ("61", "Orne", "Alencon", 48.43, 0.09, "28", 135.0),
    ("62", "Pas-de-Calais", "Arras", 50.29, 2.78, "32", 57.0),
    ("63", "Puy-de-Dome", "Clermont-Ferrand", 45.78, 3.08, "84", 401.0),
    ("64", "Pyrenees-Atlantiques", "Pau", 43.3, -0.37, "75", 190.0),
    ("65", "Hautes-Pyrenees", "Tarbes", 43.23, 0.08, "76", 304.0),
    ("66", "Pyrenees-Orientales", "Perpignan", 42.7, 2.9, "76", 40.0),
    ("67", "Bas-Rhin", "Strasbourg", 48.57, 7.75, "44", 142.0),
    ("68", "Haut-Rhin", "Colmar", 48.08, 7.36, "44", 194.0),
    ("69", "Rhone", "Lyon", 45.76, 4.84, "84", 175.0),
    ("70", "Haute-Saone", "Vesoul", 47.62, 6.15, "27", 221.0),
    ("71", "Saone-et-Loire", "Macon", 46.31, 4.83, "27", 180.0),
    ("72", "Sarthe", "Le Mans", 48.0, 0.2, "52", 55.0),
    ("73", "Savoie", "Chambery", 45.57, 5.92, "84", 270.0),
    ("74", "Haute-Savoie", "Annecy", 45.9, 6.13, "84", 448.0),
    ("75", "Paris", "Paris", 48.86, 2.35, "11", 35.0),
    ("76", "Seine-Maritime", "Rouen", 49.44, 1.1, "28", 12.0),
    ("77", "Seine-et-Marne", "Melun", 48.54, 2.66, "11", 43.0),
    ("78", "Yvelines", "Versailles", 48.8, 2.13, "11", 132.0),
    ("79", "Deux-Sevres", "Niort", 46.33, -0.46, "75", 62.0),
    ("80", "Somme", "Amiens", 49.89, 2.3, "32", 34.0),
    ("81", "Tarn", "Albi", 43.93, 2.15, "76", 174.0),
    ("82", "Tarn-et-Garonne", "Montauban", 44.02, 1.35, "76", 82.0),
    ("83", "Var", "Toulon", 43.12, 5.93, "93", 2.0),
    ("84", "Vaucluse", "Avignon", 43.95, 4.81, "93", 23.0),
    ("85", "Vendee", "La Roche-sur-Yon", 46.67, -1.43, "52", 72.0),
    ("86", "Vienne", "Poitiers", 46.58, 0.34, "75", 120.0),
    ("87", "Haute-Vienne", "Limoges", 45.83, 1.26, "75", 300.0),
    ("88", "Vosges", "Epinal", 48.17, 6.45, "44", 324.0),
    ("89", "Yonne", "Auxerre", 47.8, 3.57, "27", 100.0),
    ("90", "Territoire de Belfort", "Belfort", 47.64, 6.86, "27", 352.0),
    ("91", "Essonne", "Evry", 48.63, 2.44, "11", 80.0),
    ("92", "Hauts-de-Seine", "Nanterre", 48.89, 2.21, "11", 35.0),
    ("93", "Seine-Saint-Denis", "Bobigny", 48.91, 2.44, "11", 49.0),
    ("94", "Val-de-Marne", "Creteil", 48.79, 2.46, "11", 37.0),
    ("95", "Val-d'Oise", "Pontoise", 49.05, 2.1, "11", 30.0),
]

# Region code, region name.
REGION_ROWS = [
    ("11", "Ile-de-France"),
    ("24", "Centre-Val de Loire"),
    ("27", "Bourgogne-Franche-Comte"),
    ("28", "Normandie"),
    ("32", "Hauts-de-France"),
    ("44", "Grand Est"),
    ("52", "Pays de la Loire"),
    ("53", "Bretagne"),
    ("75", "Nouvelle-Aquitaine"),
    ("76", "Occitanie"),
    ("84", "Auvergne-Rhone-Alpes"),
    ("93", "Provence-Alpes-Cote d'Azur"),
    ("94", "Corse"),
]

# Label, category, energy source, renewable.
EQUIPMENT_ROWS = [
    ("PAC air-air", "mixte", "electricite", True),
    ("PAC air-eau", "chauffage", "electricite", True),
    ("PAC géothermique", "chauffage", "electricite", True),
    ("Climatisation réversible", "climatisation", "electricite", False),
    ("Climatisation split", "climatisation", "electricite", False),
    ("Chaudière gaz", "chauffage", "gaz", False),
    ("Chaudière fioul", "chauffage", "fioul", False),
    ("Chaudière bois", "chauffage", "bois", True),
    ("Radiateur électrique", "chauffage", "electricite", False),
    ("Poêle à bois", "chauffage", "bois", True),
]

GEO_SCHEMA = T.StructType(
    [
        T.StructField("dept", T.StringType(), False),
        T.StructField("dept_name", T.StringType(), False),
        T.StructField("city_ref", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("region_code", T.StringType(), False),
        T.StructField("elevation", T.DoubleType(), False),
        T.StructField("geo_id", T.IntegerType(), False),
    ]
)


def geo_rows() -> list[tuple]:
    return [(*row, key) for key, row in enumerate(DEPARTMENT_ROWS, 1)]


def geo_dimension(spark: SparkSession) -> DataFrame:
    """One row per department: 96 rows by construction, so always safe to broadcast."""
    return spark.createDataFrame(geo_rows(), GEO_SCHEMA)


def region_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGION_ROWS, "region_code string, region_name string")


def equipment_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        EQUIPMENT_ROWS, "label string, category string, energy_source string, is_renewable boolean"
    )


def departments_for_scope(scope: str) -> list[str]:
    """Department codes of a region code, or of the whole country for ``FR``."""
    return [r[0] for r in geo_rows() if scope.upper() == "FR" or r[5] == scope]


def calendar(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Month dimension between two date columns of a one-row frame of bounds."""
    months = bounds.select(
        F.explode(
            F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
        ).alias("month_start")
    )
    m = F.month("month_start")
    return months.select(
        (F.year("month_start") * 100 + m).cast("int").alias("date_id"),
        F.year("month_start").alias("year"),
        m.alias("month"),
        F.quarter("month_start").alias("quarter"),
        m.isin(1, 2, 3, 10, 11, 12).alias("is_heating"),
        m.isin(6, 7, 8, 9).alias("is_cooling"),
    )
