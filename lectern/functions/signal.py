"""Waveform expressions. Samples are arrays of doubles within one row; long signals use the long form in operators.signal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(samples: Column) -> Column:
    """Widened first, so that no step is done in single precision."""
    return samples.cast("array<double>")


def clamp(x: Column) -> Column:
    """To [-1, 1]; NaN stays NaN."""
    return F.when(F.isnan(x), x).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)))


def pcm16(x: Column) -> Column:
    """A sample in [-1, 1] as a 16-bit number, halves to even."""
    return F.rint(clamp(x) * 32767.0).cast("smallint")


def channels(samples: Column, n: int, length: int) -> Column:
    """A flat array as n channels of a given length."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda c: F.slice(samples, c * length + 1, F.lit(length)))


def transposed(rows: Column) -> Column:
    """Channels first to samples first, or back."""
    return F.transform(F.sequence(F.lit(0), F.size(F.get(rows, F.lit(0))) - 1), lambda i: F.transform(rows, lambda r: F.get(r, i)))


def samples_first(rows: Column) -> Column:
    """What a writer does with two dimensions: transpose if the first is at most 16 and not larger than the second."""
    n, m = F.size(rows), F.size(F.get(rows, F.lit(0)))
    return F.when((n <= 16) & (m >= n), transposed(rows)).otherwise(rows)


def downmix(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: (a + b) / 2)


def resampled_length(n: Column, old_rate: int, new_rate: int) -> Column:
    return F.greatest(F.lit(1), F.rint(n * F.lit(float(new_rate)) / F.lit(float(old_rate))).cast("int"))


def source_position(i: Column, n: Column, m: Column) -> Column:
    """Where point i of m lies among n points whose cells cover the same time; never before the first."""
    return F.greatest((i + 0.5) * (n.cast("double") / m.cast("double")) - 0.5, F.lit(0.0))


def between(low: Column, high: Column, fraction: Column) -> Column:
    return low * (1.0 - fraction) + high * fraction


def energy(samples: Column) -> Column:
    return F.aggregate(samples, F.lit(0.0), lambda a, x: a + x * x)


def peak(samples: Column) -> Column:
    return F.array_max(F.transform(samples, lambda x: F.abs(x)))


def rms(samples: Column) -> Column:
    return F.sqrt(energy(samples) / F.size(samples))


def fade_in(p: Column, n: Column) -> Column:
    """Point p of n points from 0 to 1, both ends included; a single point is 0."""
    return F.when(n > 1, p / (n - 1)).otherwise(F.lit(0.0))


def audio_metadata(rows: Column, sample_rate: int) -> Column:
    return F.struct(
        F.lit(sample_rate).alias("sample_rate"),
        F.size(F.get(rows, F.lit(0))).alias("num_frames"),
        F.size(rows).alias("num_channels"),
        F.lit(0).alias("bits_per_sample"),
        F.lit("UNKNOWN").alias("encoding"),
    )


#: The names of resampling methods that may be asked for; all mean linear interpolation here.
METHODS = ("sinc_fast", "sinc_best", "kaiser_fast", "kaiser_best")


def checked_method(method: Column) -> Column:
    """The method actually used; an unknown name is an error."""
    return F.when(method.isin(*METHODS), F.lit("linear")).otherwise(F.raise_error(F.concat(F.lit("method must be one of " + ", ".join(METHODS) + ": "), F.coalesce(method, F.lit("null")))))
