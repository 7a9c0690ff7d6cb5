"""Filter chains as text: notches for mains hum, profiles, overrides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Settings of the cleaning profiles.
HARMONICS, MAX_FREQUENCY, NOTCH_WIDTH, LOW_PASS, NOISE_REDUCTION, NOISE_FLOOR = 10, 900, 8, 12000, 6, -35
GENTLE = "highpass=f=70,lowpass=f=12000,afftdn=nr=5:nf=-40"
NOTHING = "anull"


def notches(base: Column, harmonics: int = HARMONICS, most: int = MAX_FREQUENCY, width: int = NOTCH_WIDTH) -> Column:
    """One band-reject filter for each harmonic up to a frequency, each wider by 1 than the one before."""
    within = F.filter(F.sequence(F.lit(1), F.lit(harmonics)), lambda h: base * h <= most)
    return F.transform(within, lambda h: F.concat(F.lit("bandreject=f="), (base * h).cast("string"), F.lit(":w="), (h + (width - 1)).cast("string")))


def pre_clean(profile: Column, base: Column, dual: Column, override: Column) -> Column:
    """The chain of a profile, or an override that is not empty; an unknown profile is an error."""
    other = F.when(base == 60, F.lit(50)).otherwise(F.lit(60))
    parts = F.concat(
        F.array(F.lit("highpass=f=75"), F.lit(f"lowpass=f={LOW_PASS}")),
        notches(base),
        F.when(dual, notches(other)).otherwise(F.array().cast("array<string>")),
        F.array(F.lit(f"afftdn=nr={NOISE_REDUCTION}:nf={NOISE_FLOOR}")),
    )
    return (
        F.when(F.coalesce(override, F.lit("")) != "", override)
        .when(profile == "none", F.lit(NOTHING))
        .when(profile == "gentle", F.lit(GENTLE))
        .when(profile.isin("hum", "electronic"), F.array_join(parts, ","))
        .otherwise(F.raise_error(F.concat(F.lit("unknown profile: "), F.coalesce(profile, F.lit("null")))))
    )
