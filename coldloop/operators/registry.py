"""The model registry: labels, artifacts and the paths derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Family, label and artifact of every registered model.
MODELS = (
    ("physiciens", "LSTM 128u Attention", "lstm_128u_Attention"),
    ("physiciens", "LSTM 128u NoAttention", "lstm_128u_NoAttention"),
    ("physiciens", "LSTM 64u Attention", "lstm_64u_Attention"),
    ("physiciens", "LSTM 64u NoAttention", "lstm_64u_NoAttention"),
    ("energetiques", "XGBoost Depth 3", "modele_financier_depth_3.json"),
    ("energetiques", "XGBoost Depth 5", "modele_financier_depth_5.json"),
    ("energetiques", "XGBoost Depth 7", "modele_financier_depth_7.json"),
    ("energetiques", "XGBoost Depth 9", "modele_financier_depth_9.json"),
)
THERMAL, ENERGY = "physiciens", "energetiques"
MODEL_ROOT = "trained_models"


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MODELS), "family string, label string, artifact string")


def normalised(name: Column) -> Column:
    return F.lower(F.replace(name, F.lit(" "), F.lit("_")))


def with_paths(models: DataFrame) -> DataFrame:
    """Model, scaler and the three pictures of each registry row."""
    artifact = F.trim("artifact")
    thermal = F.col("family") == THERMAL
    folder = F.concat_ws("/", F.lit(MODEL_ROOT), F.concat(F.lit("modeles_"), "family"))
    own_folder = F.concat_ws("/", folder, artifact)
    suffix = F.replace(artifact, F.lit("lstm_"), F.lit(""))
    thermal_file = F.concat(F.lit("modele_physicien_"), artifact, F.lit(".keras"))
    pictures = {
        "picture_path": F.concat(F.lit("validation_vs_test_"), suffix, F.lit(".png")),
        "importance_path": F.concat(F.lit("feature_importance_lstm_"), suffix, F.lit(".png")),
        "curve_path": F.concat(F.lit("learning_curve_"), suffix, F.lit(".png")),
    }
    return models.select(
        "*",
        F.when(thermal, F.concat_ws("/", own_folder, thermal_file)).otherwise(own_folder)
        .alias("model_path"),
        F.when(thermal, F.concat_ws("/", own_folder, F.lit("scaler.pkl"))).alias("scaler_path"),
        *(F.when(thermal, F.concat_ws("/", own_folder, picture)).alias(name)
          for name, picture in pictures.items()),
    )


def lookup(names: DataFrame, models: DataFrame, name: str = "label") -> DataFrame:
    """Attaches registry rows by trimmed label; the registry is eight rows."""
    keyed = names.withColumn("label", F.trim(F.col(name)))
    return keyed.join(F.broadcast(models), "label")


def family_tag(name: Column) -> Column:
    return F.when(name.contains("LSTM"), "thermal").when(name.contains("XGB"), "energy")
