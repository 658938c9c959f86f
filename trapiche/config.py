"""Names and fixed values that describe one kind of seasonal production feed.

Operators take column names from a `FeedSpec`; the default describes weekly mill
reports whose measures are cumulative within a harvest season.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names that feeds of different years use for one measure,
# old name -> canonical name.
ALIASES = {
    "azucar_total": "azucar_producida_total",
    "azucar_refinada": "azucar_producida_refinada",
    "azucar_estandar": "azucar_producida_estandar",
    "azucar_blanca_especial": "azucar_producida_blanca_especial",
    "azucar_mascabado": "azucar_producida_mascabado",
    "azucar_pol_menor_99_2": "toneladas_azucar_con_pol_menor_99_2",
    "no_s_zafra": "semana",
    "cania_molida_neta": "cana_molida_neta",
    "cania_molida_bruta": "cana_molida_bruta",
    "karbe_ton_cania_neta_teorico": "karbe_cana_neta",
    "karbe_ton_cana_bruta_teorico": "karbe_cana_bruta",
}

# Cell texts read as missing (the defaults of common CSV readers).
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


@dataclass(frozen=True)
class FeedSpec:
    """Column names of a feed, and the season range that is kept."""

    producer: str = "ingenio"
    season: str = "zafra"
    period: str = "semana"
    gross: str = "cana_molida_bruta"
    net: str = "cana_molida_neta"
    area: str = "superficie_cosechada"
    output: str = "azucar_producida_total"
    grades: tuple[str, ...] = (
        "azucar_producida_refinada",
        "azucar_producida_estandar",
        "azucar_producida_blanca_especial",
        "azucar_producida_mascabado",
    )
    reported_yields: tuple[str, ...] = ("rendimiento_campo", "rendimiento_fabrica")
    industrial_yield: str = "rendimiento_agroindustrial"
    extraction: str = "eficiencia_extraccion"
    start_year: str = "anio_inicio"
    season_yield: str = "rendimiento_promedio"
    season_field_yield: str = "rendimiento_campo_promedio"
    growth: str = "tendencia_crecimiento"
    first_season: str = "2015-2016"
    last_season: str = "2025-2026"
    aliases: dict[str, str] = field(default_factory=lambda: dict(ALIASES))

    @property
    def keys(self) -> tuple[str, ...]:
        """Names, which stay text even where they look like numbers."""
        return (self.producer, self.season)

    @property
    def summed(self) -> tuple[str, ...]:
        """Measures that add up over producers."""
        return (self.gross, self.net, self.area, self.output, *self.grades)

    @property
    def forced_numeric(self) -> tuple[str, ...]:
        """Measures that are numbers whatever the feed holds."""
        return (self.gross, self.net, self.area, self.output)

    @property
    def kept(self) -> tuple[str, ...]:
        """Columns carried from the feed, in output order."""
        return (self.producer, self.season, self.period, *self.summed, *self.reported_yields)

    @property
    def detail_schema(self) -> T.StructType:
        doubles = (*self.summed, *self.reported_yields, self.industrial_yield, self.extraction)
        return T.StructType(
            [T.StructField(c, T.StringType()) for c in (self.producer, self.season)]
            + [T.StructField(c, T.DoubleType()) for c in doubles]
            + [T.StructField(self.start_year, T.IntegerType())]
        )

    @property
    def season_schema(self) -> T.StructType:
        doubles = (*self.summed, self.season_yield, self.season_field_yield, self.growth)
        return T.StructType(
            [T.StructField(self.season, T.StringType())]
            + [T.StructField(c, T.DoubleType()) for c in doubles]
        )


DEFAULT_SPEC = FeedSpec()
