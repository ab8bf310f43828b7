"""Reading and printing folding energies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from foldmill.fixed_values import MFE_LINE_PATTERN, MFE_PATTERN


def energy_text(line: Column) -> Column:
    """The bracketed energy that ends a folding-output line, or null."""
    return F.nullif(F.regexp_extract(line, MFE_LINE_PATTERN, 1), F.lit(""))


def valid_energy(text: Column) -> Column:
    """The energy as a number, or null where the text is not one."""
    return F.when(text.rlike(MFE_PATTERN), text.try_cast("double"))


def first_energy(output: Column) -> Column:
    """First energy in a whole folding output of several lines."""
    energies = F.array_compact(F.transform(F.split(output, "\r?\n"), energy_text))
    return valid_energy(F.get(energies, F.lit(0)))


def fixed4(value: Column) -> Column:
    """Four decimals as text; null stays null."""
    return F.when(value.isNotNull(), F.format_string("%.4f", value))


def fixed4_or_na(value: Column) -> Column:
    return F.coalesce(fixed4(value), F.lit("NA"))
