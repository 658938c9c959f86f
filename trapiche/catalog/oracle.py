"""The catalog's queries as SQL for an independent engine.

Sums run over decimals here, and critical values and p-values come from a series and
from numerical integration, so that agreement does not rest on shared arithmetic.
"""

from __future__ import annotations

MEASURES = (
    "cana_molida_bruta",
    "cana_molida_neta",
    "superficie_cosechada",
    "azucar_producida_total",
    "azucar_producida_refinada",
    "azucar_producida_estandar",
    "azucar_producida_blanca_especial",
    "azucar_producida_mascabado",
)
PLACES = {m: 2 for m in MEASURES} | {"cana_molida_bruta": 4}


def _step(value: str, places: int = 4) -> str:
    """Half up by plain arithmetic, so that ties fall alike in any engine."""
    return f"floor({value} * 1e{places} + 0.5) / 1e{places} as {value}"


def _each(template: str, separator: str = ",\n  ") -> str:
    return separator.join(template.format(m=m, p=PLACES[m]) for m in MEASURES)


PANEL = f"""
dated as (
  select *, cast(l_shipdate as date) as d,
    cast(year(cast(l_shipdate as date) - interval 9 month) as integer) as y
  from lineitem),
lines as (
  select cast(l_suppkey as varchar) as ingenio,
    cast(y as varchar) || '-' || cast(y + 1 as varchar) as zafra,
    cast(floor(date_diff('day', make_date(y, 10, 1), d) / 7) as integer) + 1 as semana,
    cast(l_quantity as decimal(18,2)) as q, cast(l_tax as decimal(4,2)) as tax,
    cast(l_extendedprice as decimal(18,2)) as price, l_returnflag, l_linestatus
  from dated),
weekly as (
  select ingenio, zafra, semana,
    sum(cast(q * (1 + tax) as decimal(18,4))) as cana_molida_bruta,
    sum(q) as cana_molida_neta,
    cast(count(*) as decimal(18,0)) as superficie_cosechada,
    sum(price) as azucar_producida_total,
    sum(case when l_returnflag = 'A' then price else 0 end) as azucar_producida_refinada,
    sum(case when l_returnflag = 'N' then price else 0 end) as azucar_producida_estandar,
    sum(case when l_returnflag = 'R' then price else 0 end) as azucar_producida_blanca_especial,
    sum(case when l_linestatus = 'O' then price else 0 end) as azucar_producida_mascabado
  from lines group by ingenio, zafra, semana),
panel as (
  select ingenio, zafra, semana,
  {_each("sum({m}) over s as {m}")}
  from weekly
  window s as (partition by ingenio, zafra order by semana
    rows between unbounded preceding and current row))"""

SNAPSHOT = """,
ranked as (
  select *, row_number() over (partition by ingenio, zafra order by semana desc) as place from panel),
latest as (select * exclude (place, semana) from ranked where place = 1)"""

DETAIL = """,
detail as (
  select *,
    case when cana_molida_neta > 0 and superficie_cosechada > 0
      then cast(azucar_producida_total as double) / cast(cana_molida_neta as double) * 100
      else 0 end as rendimiento_agroindustrial,
    case when cana_molida_bruta > 0
      then cast(cana_molida_neta as double) / cast(cana_molida_bruta as double) * 100
      else 0 end as eficiencia_extraccion,
    try_cast(split_part(zafra, '-', 1) as integer) as anio_inicio
  from latest)"""


def _rollup(keys: str, partition: str, first: str) -> str:
    return f"""
sums as (select {keys}, {_each("sum({m}) as {m}")} from latest group by {keys}),
seasons as (
  select *,
    case when cana_molida_neta > 0
      then cast(azucar_producida_total as double) / cast(cana_molida_neta as double) * 100
      else 0 end as rendimiento_promedio,
    case when superficie_cosechada > 0
      then cast(cana_molida_neta as double) / cast(superficie_cosechada as double)
      else 0 end as rendimiento_campo_promedio,
    coalesce(
      (cast(azucar_producida_total as double)
        / cast(lag(azucar_producida_total) over w as double) - 1) * 100, {first})
      as tendencia_crecimiento
  from sums window w as ({partition} order by zafra))"""


SEASONS = "," + _rollup("zafra", "", "0")
BY_MILL = "," + _rollup("ingenio, zafra", "partition by ingenio", "null")

ROWS = """,
train as (
  select ingenio, zafra, cast(cana_molida_neta as double) as x,
    cast(azucar_producida_total as double) as y,
    substr(md5(ingenio || '|' || zafra || '|42'), 1, 8) < '33333333' as is_test
  from latest)"""


def _fit(name: str, where: str = "", group: str = "") -> str:
    keys = f"{group}, " if group else ""
    tail = f" group by {group}" if group else ""
    return f""",
{name} as (
  select {keys}cast(regr_count(y, x) as bigint) as n, regr_avgx(y, x) as x_mean,
    regr_avgy(y, x) as y_mean, regr_sxx(y, x) as sxx, regr_syy(y, x) as syy,
    regr_sxy(y, x) as sxy, regr_slope(y, x) as b1, regr_intercept(y, x) as b0
  from train{where}{tail})"""


MODEL = _fit("model", " where not is_test")
FULL = _fit("fitted")
MILL_FIT = _fit("mill_model", "", "ingenio")

# Two-sided 95% points of Student's t for 1 to 10 degrees of freedom.
T95 = (
    12.7062047361747,
    4.30265272974946,
    3.18244630528371,
    2.77644510519779,
    2.57058183563632,
    2.44691185114497,
    2.36462425159278,
    2.30600413520417,
    2.2621571627982,
    2.22813885198627,
)
# Normal quantiles of 0.975 and 0.995.
Z95, Z99 = 1.959963984540054, 2.5758293035489004


def _t_crit(z: float, dof: str) -> str:
    """Series of the t quantile in powers of 1/dof around the normal quantile."""
    terms = (
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
        (27 * z**11 + 339 * z**9 + 930 * z**7 - 1782 * z**5 - 765 * z**3 + 17955 * z) / 368640,
    )
    return f"({z!r} + " + " + ".join(f"{g!r} / pow({dof}, {i})" for i, g in enumerate(terms, 1)) + ")"


def _t95_small(dof: str) -> str:
    cases = " ".join(f"when {i} then {t!r}" for i, t in enumerate(T95, 1))
    return f"(case {dof} {cases} else {_t_crit(Z95, dof)} end)"


def _stats(name: str, source: str, t_crit: str) -> str:
    return f""",
{name} as (
  select *, sst - sse as ssr, 1 - sse / sst as r2, sqrt(mse / sxx) as se_b1,
    sqrt(mse * (1.0 / n + x_mean * x_mean / sxx)) as se_b0, {t_crit} as t_crit
  from (
    select *, syy as sst, n - 2 as dof, (syy - sxy * sxy / sxx) as sse,
      (syy - sxy * sxy / sxx) / (n - 2) as mse
    from {source} where n > 2 and sxx > 0))"""


STATS = _stats("stats", "fitted", _t_crit(Z95, "dof"))
STATS_99 = _stats("stats", "fitted", _t_crit(Z99, "dof"))
MILL_STATS = _stats("mill_stats", "mill_model", _t95_small("dof"))

SCORED = """,
scored as (
  select t.*, m.b0 + m.b1 * t.x as y_hat, t.y - (m.b0 + m.b1 * t.x) as e from train t, model m)"""

METRICS = """,
sides as (
  select is_test, avg(abs(e)) as mae, sqrt(avg(e * e)) as rmse,
    1 - sum(e * e) / regr_syy(y, y) as r2, count(*) as n
  from scored group by is_test),
record as (
  select m.b1 as "coeficiente_B1", m.b0 as "intercepto_B0", a.mae as train_mae, b.mae as test_mae,
    a.rmse as train_rmse, b.rmse as test_rmse, a.r2 as train_r2, b.r2 as test_r2,
    cast(a.n + b.n as bigint) as n_samples, cast(a.n as bigint) as n_train,
    cast(b.n as bigint) as n_test
  from model m, sides a, sides b where not a.is_test and b.is_test)"""

RECORD = """
  round("coeficiente_B1", 6) as "coeficiente_B1", round("intercepto_B0", 2) as "intercepto_B0",
  round(train_mae, 2) as train_mae, round(test_mae, 2) as test_mae,
  round(train_rmse, 2) as train_rmse, round(test_rmse, 2) as test_rmse,
  round(train_r2, 8) as train_r2, round(test_r2, 8) as test_r2, n_samples, n_train, n_test"""

AHEAD = """,
steps as (
  select zafra, cast(cana_molida_neta as double) as x,
    cast(cana_molida_neta as double) / cast(lag(cana_molida_neta) over (order by zafra) as double)
      as ratio
  from seasons),
ahead as (
  select s.last_label, s.cane as siguiente_cana, m.b0 + m.b1 * s.cane as siguiente_azucar,
    s.ratio as tendencia_cana,
    cast(cast(split_part(last_label, '-', 1) as integer) + 1 as varchar) || '-'
      || cast(cast(split_part(last_label, '-', 2) as integer) + 1 as varchar) as zafra
  from (select max(zafra) as last_label, arg_max(x, zafra) * avg(ratio) as cane, avg(ratio) as ratio
    from steps) s, model m)"""

AHEAD_PLACES = """round(siguiente_cana, 3) as siguiente_cana,
  round(siguiente_azucar, 1) as siguiente_azucar, round(tendencia_cana, 8) as tendencia_cana"""


def _months(group: str, model: str, stats: str) -> str:
    """Forecast of 24 months; with a group every group has its own model and statistics."""
    keys = f"{group}, " if group else ""
    part = f"partition by {group} " if group else ""
    tail = f" group by {group}" if group else ""
    same = f"where a.{group} = m.{group} and a.{group} = s.{group}" if group else ""
    start = f"a.{group}, " if group else ""
    return f""",
best as (
  select *, max(azucar_producida_total) over ({part}) as top from seasons),
whole as (
  select {keys}zafra, cast(cana_molida_neta as double) as x,
    cast(cana_molida_neta as double)
      / cast(lag(cana_molida_neta) over ({part}order by zafra) as double) as ratio,
    row_number() over ({part}order by zafra desc) as recency
  from best where azucar_producida_total > 0.1 * top),
base as (
  select {keys}max(zafra) as last_label,
    case when count(*) >= 3 then avg(case when recency <= 3 then x end)
      else max(case when recency = 1 then x end) end as cane,
    case when count(*) >= 3 then avg(ratio) else 1.02 end as growth
  from whole{tail}),
grid as (
  select base.*, i, cast((3 - 1 + i) % 12 + 1 as integer) as mes,
    cast(greatest(cast(split_part(last_label, '-', 2) as integer), 2002) + (3 - 1 + i) // 12
      as integer) as anio
  from base, range(24) as r(i)),
cane as (
  select *, cane * pow(growth, (i + 1) / 12.0) / 12 * (1 + 0.4 * sin(pi() * (mes - 2) / 6)) as x
  from grid),
pointed as (
  select {start}a.anio, a.mes, a.x, m.b0 + m.b1 * a.x as point,
    greatest(0, s.b0 + s.b1 * a.x) as centre,
    s.t_crit * sqrt(s.mse * (1 + 1.0 / s.n + pow(a.x - s.x_mean, 2) / s.sxx)) as margin
  from cane a, {model} m, {stats} s {same}),
forecast as (
  select {keys}printf('%d-%02d', anio, mes) as "Periodo", mes as "Mes", anio as "Anio",
    round_even(x, 0) as "Cana_Molida_ton", round_even(point, 0) as "Azucar_Producida_ton",
    round_even(greatest(0, centre - margin), 0) as "Inferior_95",
    round_even(greatest(0, centre + margin), 0) as "Superior_95"
  from pointed)"""


MONTHS = _months("", "model", "stats")
MILL_MONTHS = _months("ingenio", "mill_model", "mill_stats")

ROUNDED = _each("round(cast({m} as double), {p}) as {m}")
SEASON_COLUMNS = f"""{ROUNDED},
  {_step("rendimiento_promedio")},
  {_step("rendimiento_campo_promedio")},
  round(tendencia_crecimiento, 4) as tendencia_crecimiento"""
YIELDS = f"{_step('rendimiento_agroindustrial')}, {_step('eficiencia_extraccion')}, anio_inicio"
ODD_NAME = """case when cast(ingenio as integer) % 2 = 0 then ingenio
  else 'San "' || ingenio || '", Norte' end as ingenio"""
TEXT = _each("printf('%.4f', cast({m} as double)) as {m}")


def _p_value(t: str) -> str:
    """Two-sided tail of t by Simpson's rule over the density from 0 to |t| (at most 40)."""
    steps = 20000
    return f"""(
  select greatest(0, 1 - 2 * sum(
    (case when k in (0, {steps}) then 1 when k % 2 = 1 then 4 else 2 end) * w / 3
      * exp(lgamma((dof + 1) / 2.0) - lgamma(dof / 2.0) - 0.5 * ln(dof * pi())
        - (dof + 1) / 2.0 * ln(1 + pow(k * w, 2) / dof))))
  from (select k, least(abs({t}), 40) / {steps} as w from range({steps + 1}) as r(k)))"""


BAND = """round(m.b0 + m.b1 * g.x, 2) as y_hat,
  round(m.b0 + m.b1 * g.x
    - s.t_crit * sqrt(s.mse * (1.0 / s.n + pow(g.x - s.x_mean, 2) / s.sxx)), 2) as band_lower,
  round(m.b0 + m.b1 * g.x
    + s.t_crit * sqrt(s.mse * (1.0 / s.n + pow(g.x - s.x_mean, 2) / s.sxx)), 2) as band_upper"""

INTERVAL = """,
bounded as (
  select t.*, greatest(0, s.b0 + s.b1 * t.x) as pred,
    sqrt(s.mse * (1 + 1.0 / s.n + pow(t.x - s.x_mean, 2) / s.sxx)) as se, s.t_crit
  from {rows} t, stats s)"""


def _with(*parts: str) -> str:
    return "with " + "".join(parts).strip() + "\n"


TO_LATEST = PANEL + SNAPSHOT
TO_DETAIL = TO_LATEST + DETAIL
TO_SEASONS = TO_LATEST + SEASONS
TO_MODEL = TO_LATEST + ROWS + MODEL
TO_STATS = TO_LATEST + ROWS + FULL + STATS
TO_BOTH = TO_MODEL + FULL + STATS
TO_METRICS = TO_MODEL + SCORED + METRICS
TO_MONTHS = TO_SEASONS + ROWS + MODEL + FULL + STATS + MONTHS
EXACT = """,
train as (
  select *, pos_no <= ceil(0.2 * total) as is_test
  from (
    select ingenio, zafra, cast(cana_molida_neta as double) as x,
      cast(azucar_producida_total as double) as y,
      row_number() over (order by md5(ingenio || '|' || zafra || '|42')) as pos_no,
      count(*) over () as total
    from latest))"""
DETAIL_NAMES = ",".join(
    ("ingenio", "zafra", *MEASURES, "rendimiento_agroindustrial", "eficiencia_extraccion", "anio_inicio")
)
PROFILE = f"""select count(*) as total_registros, count(distinct zafra) as total_zafras,
  count(distinct ingenio) as total_ingenios, '{DETAIL_NAMES}' as columnas from detail"""

DIRTY = """,
dirty as (
  select 'M' || ingenio as ingenio, zafra, semana,
    cast(cana_molida_bruta as double) as cana_molida_bruta,
    case when semana % 7 = 0 or semana % 5 = 0 then 0 else cast(cana_molida_neta as double) end
      as cana_molida_neta,
    case when semana % 9 = 0 then 0 else cast(superficie_cosechada as double) end
      as superficie_cosechada,
    case when semana % 6 = 0 or semana % 4 = 0 then 0 else cast(azucar_producida_total as double) end
      as azucar_producida_total,
    azucar_producida_refinada, azucar_producida_estandar, azucar_producida_blanca_especial,
    azucar_producida_mascabado,
    case when semana % 3 = 0 then '1e2' else 'n/d' end as rendimiento_campo,
    case when semana % 3 = 0 then 0.0 else 11.5 end as rendimiento_fabrica
  from panel)"""

ORACLE_SQL: dict[str, str] = {
    "panel": _with(PANEL) + f"select ingenio, zafra, semana, {ROUNDED} from panel",
    "latest_snapshot": _with(TO_LATEST) + f"select ingenio, zafra, {ROUNDED} from latest",
    "detail_derived": _with(TO_DETAIL)
    + f"""select ingenio, zafra, {ROUNDED},
  {YIELDS} from detail""",
    "season_range": _with(TO_LATEST)
    + f"""select ingenio, zafra, {ROUNDED} from latest
where length(zafra) = 9 and zafra between '1995-1996' and '1999-2000'""",
    "conform_types": _with(PANEL, DIRTY)
    + f"""select ingenio, zafra, cast(semana as double) as semana, {ROUNDED},
  rendimiento_campo, cast(rendimiento_fabrica as double) as rendimiento_fabrica from dirty""",
    "alias_union": _with(PANEL)
    + f"select ingenio, zafra, cast(semana as varchar) as semana, {TEXT} from panel",
    "csv_feeds": _with(PANEL)
    + f"select 'M' || ingenio as ingenio, zafra, cast(semana as varchar) as semana, {TEXT} from panel",
    "feed_etl": _with(TO_SEASONS) + f"select zafra, {SEASON_COLUMNS} from seasons",
    "feed_folders": _with(PANEL)
    + f"select 'M' || ingenio as ingenio, zafra, cast(semana as varchar) as semana, {TEXT} from panel",
    "detail_csv": _with(TO_DETAIL)
    + f"""select {ODD_NAME}, zafra, {ROUNDED}, cast(null as double) as rendimiento_campo,
  cast(null as double) as rendimiento_fabrica, {YIELDS} from detail""",
    "detail_table": _with(TO_DETAIL)
    + f"""select {ODD_NAME}, zafra, {ROUNDED}, cast(11.5 as double) as rendimiento_campo,
  cast(11.5 as double) as rendimiento_fabrica, {YIELDS} from detail""",
    "annual_rollup": _with(TO_SEASONS) + f"select zafra, {SEASON_COLUMNS} from seasons order by zafra",
    "mill_rollup": _with(TO_LATEST, BY_MILL)
    + f"select ingenio, zafra, {SEASON_COLUMNS} from seasons order by ingenio, zafra",
    "filter_season_mill": _with(TO_LATEST)
    + """select ingenio, zafra, round(cast(cana_molida_neta as double), 2) as cana_molida_neta,
  round(cast(azucar_producida_total as double), 2) as azucar_producida_total
from latest where zafra = '1997-1998' and ingenio = '7'""",
    "column_filter": _with(TO_LATEST)
    + """select ingenio, zafra, round(cast(cana_molida_neta as double), 2) as cana_molida_neta
from latest where zafra like '%1998%' and cana_molida_neta between 1500 and 2500""",
    "complete_seasons": _with(TO_SEASONS)
    + """select zafra, round(cast(azucar_producida_total as double), 2) as azucar_producida_total
from seasons where azucar_producida_total > 0.1 * (select max(azucar_producida_total) from seasons)""",
    "profile": _with(TO_DETAIL) + PROFILE,
    "report": _with(TO_DETAIL) + PROFILE,
    "kpi_total": _with(TO_SEASONS)
    + """select round(cast(sum(azucar_producida_total) as double), 2) as produccion_total,
  count(distinct zafra) as n_zafras from seasons""",
    "kpi_yield": _with(TO_LATEST)
    + """select round(cast(sum(azucar_producida_total) as double)
  / cast(sum(cana_molida_neta) as double) * 100, 4) as rendimiento
from latest where zafra = '1997-1998' and cana_molida_neta > 0""",
    "kpi_empty": _with(TO_LATEST)
    + """select cast(coalesce(sum(azucar_producida_total), 0) as double) as produccion_total,
  count(distinct zafra) as n_zafras, cast(0 as double) as rendimiento
from latest where zafra = 'no such season'""",
    "top_mills": _with(TO_LATEST)
    + """select ingenio,
  round(cast(sum(azucar_producida_total) as double) / 1000, 4) as azucar_producida_total
from latest group by ingenio order by sum(azucar_producida_total) desc, ingenio limit 15""",
    "preview": _with(TO_LATEST)
    + """select ingenio, zafra, round_even(cast(cana_molida_neta as double), 2) as cana_molida_neta,
  round_even(cast(azucar_producida_total as double), 2) as azucar_producida_total,
  round_even(cast(superficie_cosechada as double), 2) as superficie_cosechada
from latest order by ingenio, zafra limit 100""",
    "choices": _with(TO_LATEST)
    + """select distinct 'ingenio' as lista, ingenio as valor from latest
union all select distinct 'zafra', zafra from latest""",
    "season_series": _with(TO_SEASONS)
    + """select zafra, round(cast(azucar_producida_total as double) / 1e6, 6) as azucar_producida_total,
  round(cast(cana_molida_neta as double) / 1e6, 6) as cana_molida_neta,
  cast(split_part(zafra, '-', 1) as integer) as anio_inicio from seasons order by zafra""",
    "series_summary": _with(TO_SEASONS)
    + """select round(avg(cast(azucar_producida_total as double)), 2) as promedio,
  round(cast(min(azucar_producida_total) as double), 2) as minimo,
  round(cast(max(azucar_producida_total) as double), 2) as maximo,
  arg_min(zafra, azucar_producida_total) as zafra_minimo,
  arg_max(zafra, azucar_producida_total) as zafra_maximo from seasons""",
    "growth_factor": _with(TO_SEASONS, ROWS, MODEL, AHEAD)
    + "select round(avg(ratio), 8) as growth from steps",
    "season_ratios": _with(TO_SEASONS, ROWS, MODEL, AHEAD)
    + "select zafra, round(ratio, 8) as ratio from steps",
    "last3_mean": _with(TO_SEASONS)
    + """select round(avg(x), 4) as trailing_mean from (
  select cast(cana_molida_neta as double) as x from seasons order by zafra desc limit 3)""",
    "data_range": _with(TO_LATEST)
    + """select round(cast(least(min(cana_molida_neta), min(superficie_cosechada)) as double), 2) as low,
  round(cast(greatest(max(cana_molida_neta), max(superficie_cosechada)) as double), 2) as high
from latest""",
    "split": _with(TO_LATEST, ROWS) + "select ingenio, zafra, is_test from train",
    "split_exact": _with(TO_LATEST, EXACT) + "select ingenio, zafra, is_test from train",
    "ols_fit": _with(TO_MODEL)
    + """select n, round(x_mean, 6) as x_mean, round(y_mean, 3) as y_mean,
  round(sxx / 1e3, 3) as sxx, round(syy / 1e9, 3) as syy, round(sxy / 1e6, 3) as sxy,
  round(b1, 6) as b1, round(b0, 2) as b0 from model""",
    "mill_fit": _with(TO_LATEST, ROWS, MILL_FIT)
    + """select ingenio, n, round(x_mean, 4) as x_mean, round(b0, 1) as b0, round(b1, 4) as b1
from mill_model""",
    "ols_stats": _with(TO_STATS)
    + f"""select n, round(b0, 2) as b0, round(b1, 5) as b1, round(se_b0, 2) as se_b0,
  round(se_b1, 5) as se_b1, round(b0 / se_b0, 5) as t_b0, round(b1 / se_b1, 5) as t_b1,
  round({_p_value("b0 / se_b0")}, 7) as p_b0, round({_p_value("b1 / se_b1")}, 7) as p_b1,
  round({_p_value("sqrt(ssr / mse)")}, 7) as p_f, round(r2, 7) as "R2",
  round(1 - (1 - r2) * (n - 1) / dof, 7) as "R2_adj", round(ssr / mse, 2) as "F_stat",
  round(mse / 1e6, 3) as "MSE", round(sse / 1e9, 3) as "SSE", round(ssr / 1e9, 3) as "SSR",
  round(sst / 1e9, 3) as "SST", round(t_crit, 7) as t_crit,
  round(b0 - t_crit * se_b0, 2) as ci_b0_low, round(b0 + t_crit * se_b0, 2) as ci_b0_high,
  round(b1 - t_crit * se_b1, 5) as ci_b1_low, round(b1 + t_crit * se_b1, 5) as ci_b1_high
from stats""",
    "ols_second_pass": _with(TO_LATEST, ROWS, FULL)
    + """select m.n, round(r.sse / 1e9, 3) as "SSE", round(1 - r.sse / m.syy, 8) as "R2"
from fitted m, (select sum(pow(y - b0 - b1 * x, 2)) as sse from train, fitted) r""",
    "scored": _with(TO_MODEL, SCORED)
    + """select ingenio, zafra, is_test, round(y, 2) as azucar_producida_total,
  round(y_hat, 2) as y_hat from scored""",
    "parity_range": _with(TO_MODEL, SCORED)
    + """select round(least(min(y), min(y_hat)), 2) as low,
  round(greatest(max(y), max(y_hat)), 2) as high from scored where is_test""",
    "metrics": _with(TO_METRICS) + f"select {RECORD} from record",
    "fit_metrics": _with(TO_LATEST, ROWS, FULL)
    + """select round(m.b1, 6) as "coeficiente_B1", round(m.b0, 2) as "intercepto_B0",
  round(1 - sum(e * e) / regr_syy(y, y), 8) as test_r2, round(avg(abs(e)), 2) as test_mae,
  round(sqrt(avg(e * e)), 2) as test_rmse
from (select y, y - b0 - b1 * x as e from train, fitted), fitted m group by m.b0, m.b1""",
    "dashboard_state": _with(TO_LATEST, ROWS, FULL)
    + """select round(m.b1, 6) as "coeficiente_B1", round(m.b0, 2) as "intercepto_B0",
  round(1 - sum(e * e) / regr_syy(y, y), 8) as test_r2, round(avg(abs(e)), 2) as test_mae,
  round(sqrt(avg(e * e)), 2) as test_rmse, m.n, round(m.b0, 2) as b0, round(m.b1, 6) as b1
from (select y, y - b0 - b1 * x as e from train, fitted), fitted m group by m.b0, m.b1, m.n""",
    "filtered_band": _with(TO_BOTH)
    + f"""select g.step, round(g.x, 4) as cana_molida_neta, {BAND}
from (
  select cast(range as integer) as step, low + (high - low) * range / 99 as x
  from range(100), (select min(x) as low, max(x) as high from train where zafra = '1997-1998')) g,
  model m, stats s""",
    "filtered_parity": _with(TO_MODEL, SCORED)
    + """select ingenio, zafra, round(y, 2) as azucar_producida_total, round(y_hat, 2) as y_hat
from scored where zafra = '1997-1998'""",
    "filtered_top": _with(TO_LATEST)
    + """select ingenio, round(cast(sum(azucar_producida_total) as double), 2) as azucar_producida_total
from latest where zafra = '1997-1998' group by ingenio
order by sum(azucar_producida_total) desc, ingenio limit 15""",
    "kpi_model": _with(TO_METRICS)
    + "select round(test_r2, 8) as test_r2, round(test_mae, 2) as test_mae from record",
    "stored_model": _with(TO_SEASONS, EXACT, MODEL, SCORED, METRICS, AHEAD)
    + f"""select {RECORD}, round(b1, 6) as b1,
  printf('Y = %.4f + %.6f * X', b0, b1) as ecuacion, round(siguiente_azucar, 1) as siguiente_azucar
from record, ahead, model""",
    "model_table": _with(TO_MODEL) + "select n, round(b0, 2) as b0, round(b1, 6) as b1 from model",
    "residual_hist": _with(TO_MODEL, SCORED)
    + """, span as (select min(e) as low, max(e) as high from scored where is_test),
counted as (
  select least(cast(floor((e - low) / (high - low) * 25) as integer), 24) as bin, count(*) as c
  from scored, span where is_test group by 1)
select b.bin, round(low + (high - low) / 25 * b.bin, 1) as bin_low,
  round(low + (high - low) / 25 * (b.bin + 1), 1) as bin_high, coalesce(c, 0) as "count"
from (select cast(range as integer) as bin from range(25)) b left join counted on b.bin = counted.bin,
  span""",
    "pred_interval": _with(TO_STATS, INTERVAL.format(rows="train"))
    + """select ingenio, zafra, round(pred, 2) as pred, round(se, 2) as se,
  round(greatest(0, pred - t_crit * se), 2) as lower,
  round(greatest(0, pred + t_crit * se), 2) as upper from bounded""",
    "pred_interval_99": _with(TO_LATEST, ROWS, FULL, STATS_99, INTERVAL.format(rows="train"))
    + """select ingenio, zafra, round(greatest(0, pred - t_crit * se), 2) as lower,
  round(greatest(0, pred + t_crit * se), 2) as upper from bounded""",
    "conf_band": _with(TO_BOTH)
    + f"select g.ingenio, g.zafra, {BAND} from train g, model m, stats s",
    "line_grid": _with(TO_MODEL)
    + """select step, round(x, 4) as cana_molida_neta, round(b0 + b1 * x, 2) as y_hat
from (
  select cast(range as integer) as step, low + (high - low) * range / 99 as x
  from range(100), (select min(x) as low, max(x) as high from train)), model""",
    "whatif_band": _with(TO_BOTH)
    + f"""select g.step, round(g.x, 4) as cana_molida_neta, {BAND}
from (
  select cast(range as integer) as step, low + (high - low) * range / 99 as x
  from range(100), (select greatest(0, 0.8 * min(x)) as low, 1.1 * max(x) as high from train)) g,
  model m, stats s""",
    "whatif": _with(
        TO_BOTH,
        """,
scenario as (
  select ingenio, zafra, share, x * share as x from train, (values (0.5), (0.0)) v(share))""",
        INTERVAL.format(rows="scenario"),
    )
    + """select ingenio, zafra, cast(share as double) as share, round(x, 2) as cana,
  case when x > 0 then round(b0 + b1 * x, 2) else 0 end as pred,
  case when x > 0 then round(se, 2) else 0 end as se,
  case when x > 0 then round(greatest(0, bounded.pred - t_crit * se), 2) else 0 end as lower,
  case when x > 0 then round(greatest(0, bounded.pred + t_crit * se), 2) else 0 end as upper,
  cast(0.95 as double) as conf_level,
  case when x > 0 then round((b0 + b1 * x) / x * 100, 3) else 0 end as rendimiento
from bounded, model""",
    "forecast_next": _with(TO_SEASONS, ROWS, MODEL, AHEAD) + f"select zafra, {AHEAD_PLACES} from ahead",
    "mill_forecast_next": _with(TO_LATEST, BY_MILL, ROWS, MILL_FIT)
    + """select s.ingenio,
  cast(cast(split_part(s.label, '-', 1) as integer) + 1 as varchar) || '-'
    || cast(cast(split_part(s.label, '-', 2) as integer) + 1 as varchar) as zafra,
  round(s.cane, 3) as siguiente_cana, round(m.b0 + m.b1 * s.cane, 0) as siguiente_azucar,
  round(s.ratio, 8) as tendencia_cana
from mill_model m join (
  select ingenio, max(zafra) as label, arg_max(x, zafra) * avg(ratio) as cane, avg(ratio) as ratio
  from (
    select ingenio, zafra, cast(cana_molida_neta as double) as x,
      cast(cana_molida_neta as double)
        / cast(lag(cana_molida_neta) over (partition by ingenio order by zafra) as double) as ratio
    from seasons)
  group by ingenio) s on s.ingenio = m.ingenio""",
    "history_plus_forecast": _with(TO_SEASONS, ROWS, MODEL, AHEAD)
    + """select zafra, round(cast(cana_molida_neta as double), 2) as cana_molida_neta,
  round(cast(azucar_producida_total as double), 1) as azucar_producida_total, 'real' as tipo
from seasons
union all
select zafra, round(siguiente_cana, 2), round(siguiente_azucar, 1), 'pronostico' from ahead""",
    "forecast_24m": _with(TO_MONTHS) + "select * from forecast",
    "forecast_display": _with(TO_MONTHS)
    + """select "Periodo", "Cana_Molida_ton" as "Cana Molida (ton)",
  "Azucar_Producida_ton" as "Azucar Prod. (ton)", "Inferior_95" as "IC Inf. 95%",
  "Superior_95" as "IC Sup. 95%" from forecast""",
    "mill_forecast_24m": _with(TO_LATEST, BY_MILL, ROWS, MILL_FIT, MILL_STATS, MILL_MONTHS)
    + "select * from forecast",
    "forecast_total": _with(TO_MONTHS)
    + 'select sum("Azucar_Producida_ton") as total_azucar from forecast',
    "interpretation": _with(TO_SEASONS, ROWS, MODEL, SCORED, METRICS, AHEAD)
    + f"""select printf('Y = %.4f + %.6f * X', b0, b1) as ecuacion,
  printf('Por cada ton de cana molida, se producen %.4f ton de azucar', b1)
    as interpretacion_coeficiente,
  printf('El modelo explica el %.2f%% de la variabilidad en la produccion de azucar', test_r2 * 100)
    as r2_interpretacion,
  {AHEAD_PLACES} from record, ahead, model""",
    "interpretation_figures": _with(TO_SEASONS, ROWS, MODEL, SCORED, METRICS, AHEAD)
    + """select round(test_r2 * 100, 6) as r2_pct, round(siguiente_cana, 3) as siguiente_cana,
  round(tendencia_cana * 100 - 100, 6) as tendencia_pct, s.* from record, ahead, (
  select round(avg(cast(azucar_producida_total as double)), 2) as promedio,
    arg_min(zafra, azucar_producida_total) as zafra_minimo,
    arg_max(zafra, azucar_producida_total) as zafra_maximo from seasons) s""",
}
# The same rows by other ways: tables brought up to date by two runs, models of stored moments.
ORACLE_SQL["incremental_seasons"] = ORACLE_SQL["feed_etl"]
ORACLE_SQL["incremental_detail"] = _with(TO_DETAIL) + (
    f"select 'M' || ingenio as ingenio, zafra, {ROUNDED}, {YIELDS} from detail"
)
ORACLE_SQL["moments_mill_fit"] = ORACLE_SQL["mill_fit"]
ORACLE_SQL["moments_ols_stats"] = ORACLE_SQL["ols_stats"]
ORACLE_SQL["split_equal_keys"] = _with(PANEL) + """select ingenio, zafra, semana,
  row_number() over (order by md5(zafra || '|42'),
    md5(zafra || '|' || ingenio || '|' || semana || '|42')) <= ceil(0.2 * count(*) over ()) as is_test
from panel"""
DELIVERIES = """with deliveries as (
  select l_orderkey as pedido, l_suppkey as ingenio, zafra from (
    select *, start || '-' || (start + 1) as zafra from (
      select *, year(l_shipdate) - if(month(l_shipdate) < 10, 1, 0) as start from lineitem)))
"""
DELIVERY_COUNTS = """count(*) as n_rows, count(distinct pedido) as n_pedido,
  count(distinct ingenio) as n_ingenio, true as rows_equal, true as pedido_within,
  true as ingenio_within from deliveries"""
ORACLE_SQL["sketch_season_counts"] = f"{DELIVERIES} select zafra, {DELIVERY_COUNTS} group by zafra"
ORACLE_SQL["sketch_filtered_counts"] = (
    f"{DELIVERIES} select {DELIVERY_COUNTS} where zafra in ('1994-1995', '1995-1996', '1996-1997')"
)
