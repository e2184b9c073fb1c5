"""Unit conversions to parts per billion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv


def _lookup(species: Column, table: dict[str, float]) -> Column:
    out = F.lit(None).cast("double")
    for name, factor in table.items():
        out = F.when(species == name, F.lit(factor)).otherwise(out)
    return out


def mole_density_to_ppb(conc: Column, temperature_k: Column, pressure_mbar: Column) -> Column:
    """mol/m3 to ppb by the ideal gas law."""
    atm = pressure_mbar / fv.MILLIBAR_PER_ATM
    denominator = F.lit(fv.GAS_CONSTANT_ATM) * temperature_k * atm
    return conc * fv.MOLAR_VOLUME_PPB / F.nullif(denominator, F.lit(0.0))


def mole_density_to_ppb_at(conc: Column, pressure: Column, elevation_m: Column,
                           temperature: Column, volume: float = 1.0) -> Column:
    """mol/m3 to ppb with the pressure reduced to sea level by the barometric formula."""
    moles = conc * 1.0e-6 * volume
    scaled = pressure * 100
    drop = elevation_m * fv.LAPSE_K_PER_M
    base = 1 - drop / F.nullif(temperature + drop + fv.KELVIN_OFFSET, F.lit(0.0))
    sea_level = scaled * F.pow(base, F.lit(fv.BAROMETRIC_POWER))
    return moles * sea_level / F.nullif(scaled, F.lit(0.0)) / volume * 1.0e9


def to_ppb(value: Column, unit: Column, species: Column | str) -> Column:
    """Convert ``ppm`` and mass concentrations to ppb; ``pm25`` stays a mass concentration.

    A mass concentration of a species without a factor has no ppb value (NULL).
    """
    species = F.lit(species) if isinstance(species, str) else species
    per_ppb = _lookup(species, fv.UGM3_PER_PPB)
    return (
        F.when(species == "pm25", value)
        .when(unit == "ppm", value * fv.PPB_PER_PPM)
        .when(unit.isin("µg/m³", "ugm3"), value / per_ppb)
        .otherwise(value)
    )


def convert(value: Column, species: str, unit: str, target: str) -> Column:
    """Driver-side choice of conversion when unit and species are known for a whole file."""
    if unit == "ugm3" and target == "ppbv":
        return value * (1.0 / fv.UGM3_PER_PPB[species])
    return value


def ugm3_to_ppb(value: Column, species: str) -> Column:
    return value / fv.UGM3_PER_PPB[species]
