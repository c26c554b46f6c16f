"""Deterministic A/B assignment."""

from pyspark.sql import functions as F

from shoplens import config
from shoplens.functions.events import hash_percent


def variant(user_id):
    bucket = hash_percent(user_id.cast("string"), lambda text: F.sha2(text, 256))
    control, treatment = config.VARIANTS
    return F.when(bucket < config.CONTROL_PERCENT, control).otherwise(treatment)
