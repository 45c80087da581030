"""Several results from one pass: cube slices, hierarchies, bitmaps, daily balances, slots."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.fixtures import AS_OF, NEW, OLD, view
from saldo.functions import joins
from saldo.operators import delinquency, hierarchy, mappings
from saldo.plans import datasets
from saldo.sources import cubes


def ordered(df):
    return sorted(map(tuple, df.collect()), key=repr)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- cubes -------------------------------------------------------------------


def readings(first=registry.FIRST_CUBE, last=registry.LAST_CUBE):
    return {n: cubes.Reading(s, m, registry.CUBE_ENTITY, first, last) for n, (s, m) in registry.CUBES.items()}


@pytest.fixture(scope="module")
def cube(spark, small, tmp_path_factory):
    """The cube as one stored table."""
    place = str(tmp_path_factory.mktemp("cubo") / "t")
    view(spark, small, "fx_cube").write.parquet(place)
    return spark.read.parquet(place)


def test_eight_slices_come_from_one_scan(spark, cube):
    found = cubes.cube_slices(cube, readings())
    assert physical(found).count("FileScan parquet") == 1
    for name, (slice_, measure) in registry.CUBES.items():
        alone = slice_.read(cube, measure, registry.CUBE_ENTITY, registry.FIRST_CUBE, registry.LAST_CUBE)
        mine = cubes.one_slice(found, name, slice_)
        assert mine.columns == alone.columns and ordered(mine) == ordered(alone) and mine.count() > 0


def test_each_reading_keeps_its_own_period_and_entity(spark, cube):
    some = {
        "a": cubes.Reading(cubes.BUDGET_EXPENSE, "vl_ajustado", "EUROPE", 199901, 199912),
        "b": cubes.Reading(cubes.BUDGET_EXPENSE, "vl_ajustado", "ASIA", 200001, 200003),
        "c": cubes.Reading(cubes.EXECUTED_ENTITIES, "m_entidades", None, 199906, 200002),
    }
    found = cubes.cube_slices(cube, some)
    for name, r in some.items():
        assert ordered(cubes.one_slice(found, name, r.slice)) == ordered(r.slice.read(cube, r.measure, r.entity, r.first, r.last))


def test_missing_levels_of_the_cube_are_groups_of_their_own(spark):
    slice_ = cubes.Slice(["a", "b"], "v", 200001, 200012, one_entity=False)
    whole = cubes.Slice(["a"], "v", 200001, 200012, one_entity=False)
    fact = spark.createDataFrame([("x", None, 2000, 1, 1), ("x", "y", 2000, 2, 2), (None, None, 2000, 3, 4), ("x", None, 1999, 1, 8)], "a string, b string, vl_ano int, vl_mes int, m int")
    found = cubes.cube_slices(fact, {"fine": cubes.Reading(slice_, "m"), "coarse": cubes.Reading(whole, "m")})
    assert ordered(cubes.one_slice(found, "fine", slice_)) == [("x", "y", 2), ("x", None, 1), (None, None, 4)]
    assert ordered(cubes.one_slice(found, "coarse", whole)) == [("x", 3), (None, 4)]
    assert cubes.cube_slices(fact.limit(0), {"fine": cubes.Reading(slice_, "m")}).count() == 0


def test_datasets_share_the_pass(spark, cube):
    reads = []

    def source(name):
        reads.append(name)
        return cube

    period = {"first": registry.FIRST_CUBE, "last": registry.LAST_CUBE}
    built = datasets.cube_datasets(source, {"orcado": "vl_ajustado", "orcado_receitas": "m_receita"}, registry.CUBE_ENTITY, **period)
    for name, measure in (("orcado", "vl_ajustado"), ("orcado_receitas", "m_receita")):
        alone = datasets.cube_dataset(name, lambda _: cube, measure, registry.CUBE_ENTITY, **period)
        assert ordered(built[name]()) == ordered(alone)
    assert reads == ["CUBO"]


# --- hierarchies -------------------------------------------------------------


def plan_of_accounts(spark, depth, leaves=12):
    """Dotted accounts with ``depth`` parts; the names say where each one stands."""
    draw, rows = random.Random(depth), {}
    for k in range(leaves):
        parts = [str(draw.randint(1, 2)) for _ in range(depth - 1)] + [f"{k:02d}"]
        for n in range(1, depth + 1):
            rows[".".join(parts[:n])] = (f"name {'.'.join(parts[:n])}", int(n == depth))
    return spark.createDataFrame([(c, c[-2:], n, a) for c, (n, a) in rows.items()], "codconta string, reduzido string, descricao string, analitica int")


@pytest.mark.parametrize("depth", [3, 8])
def test_plans_of_accounts_of_other_depths(spark, depth):
    accounts = plan_of_accounts(spark, depth)
    prefixes = {level: 2 * level - 1 for level in range(depth - 1, 0, -1)}
    got = hierarchy.account_hierarchy(accounts, mappings.category_table(spark, "X"), prefixes).collect()
    leaves = [r.codconta for r in accounts.filter("analitica = 1").collect()]
    assert sorted(r[f"cdgcontanvl{depth}"] for r in got) == sorted(leaves)
    for r in got:
        for level in range(1, depth):
            above = ".".join(r[f"cdgcontanvl{depth}"].split(".")[:level])
            assert (r[f"cdgcontanvl{level}"], r[f"desccontanvl{level}"]) == (above, f"name {above}")


def test_ancestors_by_separator(spark):
    codes = spark.createDataFrame([("1.22.3|x.4",), ("7",), ("",), (None,), ("1.22",)], "codigo string")
    got = ordered(hierarchy.ancestor_codes(codes))
    assert got == [("1.22", 1, "1"), ("1.22.3|x.4", 1, "1.22.3|x"), ("1.22.3|x.4", 2, "1.22"), ("1.22.3|x.4", 3, "1")]
    assert ordered(hierarchy.ancestor_codes(codes, separator="|")) == [("1.22.3|x.4", 1, "1.22.3")]


def test_a_missing_ancestor_is_null_and_accounts_are_read_three_times(spark, tmp_path):
    place = str(tmp_path / "contas")
    plan_of_accounts(spark, 6).filter("length(codconta) <> 5").write.parquet(place)
    levels = hierarchy.account_hierarchy(spark.read.parquet(place), mappings.category_table(spark, "X"), {5: 9, 4: 7, 3: 5, 2: 3, 1: 1})
    assert all(r.cdgcontanvl3 is None and r.cdgcontanvl4 and r.cdgcontanvl2 for r in levels.collect())
    # leaves, their codes and the names, at any depth
    assert levels._jdf.queryExecution().optimizedPlan().toString().count("] parquet") <= 3


# --- bitmaps -----------------------------------------------------------------


def flags_of(spark, rows):
    frame = spark.createDataFrame(rows, "cdg_idmov string, cdg_codtmv string, ano_venc int, dt_datacriacao timestamp, data_limite_corte timestamp")
    return frame


def some_flags(spark, n=4000, seed=1):
    draw = random.Random(seed)
    day = lambda k: dt.datetime(2000, 1, 1) + dt.timedelta(days=k)
    rows = [(f"m{draw.randrange(n // 3)}", draw.choice(["a", "b", None]), draw.choice([1999, 2000]), day(draw.randrange(200)), day(150)) for _ in range(n)]
    return flags_of(spark, rows + [("<NA>", "a", 1999, day(1), day(9))] * 3)


def test_bitmaps_count_distinct_invoices(spark):
    flags = some_flags(spark)
    numbers = delinquency.invoice_numbers(delinquency.created_in_time(flags))
    assert sorted(r.numero for r in numbers.collect()) == list(range(numbers.count()))
    bitmaps = delinquency.invoice_bitmaps(flags, numbers)
    assert ordered(delinquency.invoices_from_bitmaps(bitmaps, 1999, 2000)) == ordered(delinquency.invoices_by_channel(flags, 1999, 2000))
    cohort = delinquency.created_in_time(flags)
    for by in ([], ["ano_venc"], ["cdg_codtmv"], ["ano_venc", "cdg_codtmv"]):
        want = cohort.groupBy(*by).agg(F.count_distinct("cdg_idmov"))
        assert ordered(delinquency.count_bitmaps(bitmaps.withColumnRenamed("tipo_mov", "cdg_codtmv"), by)) == ordered(want)


def test_stored_months_are_merged(spark, tmp_path):
    """Each month is numbered after the earlier ones and stored; their union counts as if loaded at once."""
    flags = some_flags(spark).withColumn("_month", F.month("dt_datacriacao"))
    place, known = str(tmp_path / "mapas"), None
    for month in range(1, 8):
        part = flags.filter(F.col("_month") == month).drop("_month")
        known = delinquency.invoice_numbers(delinquency.created_in_time(part), known).checkpoint()
        delinquency.invoice_bitmaps(part, known).write.mode("append").parquet(place)
    assert known.select("numero").distinct().count() == known.count()
    stored = spark.read.parquet(place)
    assert ordered(delinquency.invoices_from_bitmaps(stored, 1999, 2000)) == ordered(delinquency.invoices_by_channel(flags, 1999, 2000))
    assert delinquency.count_bitmaps(stored, []).first().notas == delinquency.created_in_time(flags).select("cdg_idmov").distinct().count()
    assert delinquency.count_bitmaps(stored.limit(0), []).first().notas == 0


def test_numbers_beyond_one_bitmap(spark):
    n = 70_000
    flags = spark.range(n).select(
        F.col("id").cast("string").alias("cdg_idmov"), F.lit("a").alias("cdg_codtmv"), F.lit(2000).alias("ano_venc"),
        F.lit("2000-01-01").cast("timestamp").alias("dt_datacriacao"), F.lit("2000-02-01").cast("timestamp").alias("data_limite_corte"),
    )
    bitmaps = delinquency.invoice_bitmaps(flags.union(flags), delinquency.invoice_numbers(flags))
    assert bitmaps.count() == 3 and delinquency.count_bitmaps(bitmaps, []).first().notas == n


# --- daily balances ----------------------------------------------------------


def open_and_late(flags):
    late = flags.filter(F.col("is_inadimplente") & (F.col("status_simplificado") == mappings.OPEN))
    sums = late.groupBy("cdg_codtmv").agg(F.count("*").alias("n"), F.sum("vl_valororiginal").alias("v"))
    return {r.cdg_codtmv: (r.n, r.v) for r in sums.collect()}


def balances(daily, day):
    return {r.tipo_mov: (r.parcelas, r.valor) for r in daily.filter(F.col("dia") == day).collect() if r.parcelas}


def test_daily_balance_equals_the_flags_at_their_dates(spark, small):
    base = registry._base(spark, small).checkpoint()
    daily = delinquency.delinq_daily(base, "1999-06-30", AS_OF).checkpoint()
    flags = delinquency.delinq_flags(base, AS_OF, OLD)
    for year, day in ((OLD, "1999-06-30"), (NEW, AS_OF)):
        mine = delinquency.delinq_daily(base.filter(F.col("ano_venc") == year), "1999-06-30", AS_OF)
        assert balances(mine, day) == open_and_late(flags.filter(F.col("ano_venc") == year)) != {}
    assert daily.count() == 367 * base.select("cdg_codtmv").distinct().count()


def test_daily_balance_equals_brute_force_at_random_dates(spark):
    draw, start = random.Random(3), dt.datetime(2000, 1, 1)
    moment = lambda: start + dt.timedelta(hours=draw.choice([24 * draw.randrange(400), draw.randrange(9600)]))
    rows = []
    for k in range(600):
        due = moment() if draw.random() > 0.05 else None
        paid = moment() if draw.random() > 0.4 else None
        rows.append((k, draw.choice(["a", "b", None]), draw.choice([" Baixado ", "Em Aberto", "BAIXADO", None]), due, paid, Decimal(draw.randrange(1, 999)), 2000))
    base = spark.createDataFrame(rows, "cdg_idlan int, cdg_codtmv string, nm_descstatuslcto string, dt_datavencimento timestamp, dt_databaixa timestamp, vl_valororiginal decimal(38,8), ano_venc int")
    daily = {}
    for r in delinquency.delinq_daily(base, "2000-01-10", "2001-01-20").collect():
        daily[r.dia, r.tipo_mov] = (r.parcelas, r.valor)
    for _ in range(50):
        day = dt.datetime(2000, 1, 10) + dt.timedelta(days=draw.randrange(376))
        for channel in ("a", "b", None):
            hit = [
                v for _, c, status, due, paid, v, _ in rows
                if c == channel
                and ((paid and due and paid > due) or (paid is None and due and due < day))
                and not (status and status.strip().lower() == "baixado" and paid and paid <= day)
            ]
            assert daily[day.date(), channel] == (len(hit), sum(hit, Decimal(0)))


def test_daily_balance_of_nothing(spark, small):
    assert delinquency.delinq_daily(registry._base(spark, small).limit(0), "2000-01-01", "2000-02-01").count() == 0


# --- slots -------------------------------------------------------------------


def test_slots_do_not_depend_on_the_order_of_rows(spark):
    """A recomputed shuffle may bring the rows in another order; their slots stay."""
    rows = [(1, n % 40, None if n % 3 else "x") for n in range(400)] + [(2, 7, "same")] * 300
    shuffled = rows[:]
    random.Random(2).shuffle(shuffled)
    one = spark.createDataFrame(rows, "k int, a int, b string").repartition(7)
    two = spark.createDataFrame(shuffled, "k int, a int, b string").coalesce(1)
    first, second = (ordered(joins.dealt(d.withColumn("_slots", F.lit(5)))) for d in (one, two))
    assert first == second and [r[:3] for r in first] == sorted(rows, key=repr)
    assert {r[3] for r in first} == set(range(5))
    same = [r[3] for r in first if r[0] == 2]
    assert [same.count(k) for k in range(5)] == [60] * 5


def test_a_join_read_in_two_orders_is_the_same(spark):
    left = spark.createDataFrame([(k % 3, k) for k in range(30)], "k int, l int")
    right = spark.createDataFrame([(0, n % 50) for n in range(500)] + [(1, 1)], "rk int, r int")
    plain = ordered(left.join(right, left.k == right.rk, "left"))
    for turned in (right.repartition(9), right.orderBy(F.desc("r")), right.repartition(2, "r")):
        assert ordered(joins.skewed_left_join(left, turned, {"k": "rk"}, rows_per_task=100, max_bytes=0)) == plain
