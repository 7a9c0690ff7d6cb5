"""Whole filter chains on samples: the text of a chain, as filters.pre_clean makes it or settings give it, applied stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lectern.functions.recurrent import LINEAR, section, stages

from .dynamics import LIMIT, limited
from .loudness import normalised
from .recurrent import filtered
from .spectral import FRAME, denoised

#: Chains of the reference settings, and what a stage takes where its chain does not say.
SAFE = "highpass=f=70,lowpass=f=12000,afftdn=nr=6:nf=-35,loudnorm=I=-24:LRA=11:TP=-3:linear=true"
POST = "highpass=f=70,lowpass=f=12000,loudnorm=I=-24:LRA=11:TP=-3:linear=true"
OLDER_POST = "highpass=f=70,loudnorm=I=-16:LRA=11:TP=-1.5,alimiter=limit=0.95"
DEFAULTS = {"nr": 12.0, "nf": -50.0, "I": -24.0, "TP": -2.0}


def applied(chunks: DataFrame, keys: list[str], rate: int, chain: str, frame: int = FRAME) -> DataFrame:
    """(keys, start, samples): chunk rows through all stages of a chain, in order; an unknown stage is an error.

    Recurrent filters that follow one another are one pass (operators.recurrent), whatever their number. afftdn turns noise
    down in the spectrum, loudnorm is one gain to a loudness within a true peak (its range, LRA, is measured, not changed),
    alimiter limits peaks. What a stage takes but does not know of is left out, as its other settings are of no effect here.
    Samples of a signal of one lane come out of filters and limiters as plain formulas give them, to the last digit. A limiter
    with stages behind it may therefore be a last digit above its limit, which they change anyway; at the end of a chain it never is.
    """

    def setting(args: dict[str, str], name: str) -> float:
        return float(args.get(name, DEFAULTS[name]))

    linear: list[str] = []
    out = chunks.select(*keys, "start", "samples")

    def through(rows: DataFrame) -> DataFrame:
        nonlocal linear
        text, linear = ",".join(linear), []
        return filtered(rows, keys, rate, text, divided=True) if text else rows

    found = [(name, args) for name, args in stages(chain) if name not in LINEAR or section(name, args, rate)]
    for place, (name, args) in enumerate(found, 1):
        if name in LINEAR:
            linear.append(name + "=" + ":".join(f"{k}={v}" for k, v in args.items()))
            continue
        out = through(out)
        if name == "afftdn":
            out = denoised(out, keys, setting(args, "nr"), setting(args, "nf"), frame)
        elif name == "loudnorm":
            out = normalised(out, keys, rate, setting(args, "I"), setting(args, "TP"))
        elif name == "alimiter":
            out = limited(out, keys, rate, float(args.get("limit", LIMIT)), cut=place == len(found))
        else:
            raise ValueError(f"unknown stage of a chain: {name}")
    return through(out)
