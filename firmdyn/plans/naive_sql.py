"""The statistics in their naive, reference-shaped form, as SQL text.

Windows for shares and means, one join per horizon, left joins to stitch horizons.
This is an independent derivation of every result: DuckDB runs it as the oracle of
the correctness checks, and Spark runs it (``dialect="spark"``) as the naive plan
the optimised operators are benchmarked against. Both engines read the same text;
the two dialects differ only in the quantile and string-list aggregates.
"""

from __future__ import annotations

from firmdyn.schema import PRESHOCK, TREATMENT, LongDiffSpec

# The derived firm-year panel over the driver tables.
DRIVER_PANEL_SQL = """
select lpad(cast(c_nationkey as string), cast(greatest(length(cast(c_nationkey as string)), 2) as int), '0')
       || lpad(cast(c_custkey as string), cast(greatest(length(cast(c_custkey as string)), 9) as int), '0') as bvd_id,
       case c_mktsegment when 'AUTOMOBILE' then 3711 when 'BUILDING' then 1520
                         when 'FURNITURE' then 2510 when 'MACHINERY' then 3500
                         when 'HOUSEHOLD' then 3630 end as sic,
       year(l_shipdate) + 14 as year,
       sum(l_extendedprice * (1 - l_discount)) as sales,
       sum(case when l_returnflag <> 'R' then l_quantity * p_retailprice end) as costs_of_goods_sold,
       sum(case when l_linestatus = 'O' then l_quantity end) as number_of_employees,
       sum(l_extendedprice * l_tax) as total_assets
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join part on l_partkey = p_partkey
group by 1, 2, 3
"""

CELL = "_country_, sic"
CELL_YEAR = "_country_, sic, year"
MEASURES = "sales, costs_of_goods_sold, number_of_employees, total_assets"


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"


class Sql:
    """A chain of named CTEs ending in one select."""

    def __init__(self, raw_panel: str = DRIVER_PANEL_SQL, dialect: str = "duckdb"):
        self.dialect = dialect
        self.ctes: list[tuple[str, str]] = []
        self.add("panel", f"""
            select bvd_id, substring(bvd_id, 1, 2) as _country_,
                   substring(cast(sic as string), 1, 2) as sic, year, {MEASURES}
            from ({raw_panel}) raw_panel""")

    def add(self, name: str, body: str) -> str:
        if all(n != name for n, _ in self.ctes):
            self.ctes.append((name, body))
        return name

    def render(self, final: str) -> str:
        return "with " + ",\n".join(f"{n} as ({b})" for n, b in self.ctes) + "\n" + final

    # ---- samples -----------------------------------------------------------------
    def positive_sales(self) -> str:
        return self.add("pos", "select * from panel where sales is not null and sales > 0")

    def shares_all(self) -> str:
        pos = self.positive_sales()
        return self.add("pos_share", f"""
            select *, sales / sum(sales) over (partition by {CELL_YEAR}) as share from {pos}""")

    def firm_markup(self) -> str:
        self.add("mk_raw", """
            select *, case when costs_of_goods_sold > 0 then sales / costs_of_goods_sold end as markup
            from panel
            where costs_of_goods_sold is not null and costs_of_goods_sold > 0
              and sales is not null and sales > 0""")
        self.add("mk_trim", "select * from mk_raw where markup >= 0.5 and markup <= 10")
        return self.add("firm_mk", f"""
            select *, sales / sum(sales) over (partition by {CELL_YEAR}) as share from mk_trim""")

    # ---- by-year tables ------------------------------------------------------------
    def opcov_by_year(self) -> str:
        self.add("oc_s", f"""
            select *, sales / sum(sales) over (partition by {CELL_YEAR}) as share,
                   ln(case when number_of_employees > 0 then sales / number_of_employees end) as labor_prod
            from panel
            where number_of_employees is not null and number_of_employees > 0
              and sales is not null and sales > 0""")
        self.add("oc_d", f"""
            select *, share - avg(share) over (partition by {CELL_YEAR}) as d_share,
                   labor_prod - avg(labor_prod) over (partition by {CELL_YEAR}) as d_prod
            from oc_s""")
        return self.add("opcov_by_year", f"""
            select {CELL_YEAR}, sum(d_share * d_prod) as opcov from oc_d group by {CELL_YEAR}""")

    def dispersion_by_year(self) -> str:
        pos = self.positive_sales()

        def lg(den: str) -> str:
            return f"case when {den} is not null and {den} > 0 then ln(sales / {den}) end"

        return self.add("disp_by_year", f"""
            select {CELL_YEAR},
                   stddev_samp({lg('number_of_employees')}) as sigma_mrpl,
                   stddev_samp({lg('total_assets')}) as sigma_mrpk,
                   stddev_samp({lg('costs_of_goods_sold')}) as sigma_markup
            from {pos} group by {CELL_YEAR}""")

    def concentration_by_year(self) -> str:
        s = self.shares_all()
        self.add("cr_rank", f"""
            select *, row_number() over (partition by {CELL_YEAR} order by share desc) as rk from {s}""")
        self.add("cr4_t", f"select {CELL_YEAR}, sum(share) as cr4 from cr_rank where rk <= 4 group by {CELL_YEAR}")
        self.add("nf_t", f"""
            select {CELL_YEAR},
                   count(distinct bvd_id) + max(case when bvd_id is null then 1 else 0 end) as n_firms
            from {s} group by {CELL_YEAR}""")
        return self.add("conc_by_year", """
            select c._country_, c.sic, c.year, c.cr4, n.n_firms
            from cr4_t c left join nf_t n
              on c._country_ = n._country_ and c.sic = n.sic and c.year = n.year""")

    # ---- long differences ----------------------------------------------------------
    def long_diff(self, table: str, measures: list[tuple[str, str]], spec: LongDiffSpec,
                  tag: str) -> tuple[str, list[str]]:
        """Per-horizon inner joins to the base slice, stitched by left joins."""
        b = spec.base
        base_cols = ", ".join(f"{m} as base_{m}" for m, _ in measures)
        base = self.add(f"{tag}_base_{b}", f"select {CELL}, {base_cols} from {table} where year = {b}")
        parts, cols = [], []
        for h in spec.horizons:
            diffs = ", ".join(f"h.{m} - x.base_{m} as {spec.label(lab, h)}" for m, lab in measures)
            parts.append(self.add(f"{tag}_{b}_{h}", f"""
                select x._country_, x.sic, {diffs}
                from {base} x join {table} h
                  on h.year = {h} and h._country_ = x._country_ and h.sic = x.sic"""))
            cols += [spec.label(lab, h) for _, lab in measures]
        return self.stitch(f"{tag}_ld_{b}", parts, cols), cols

    def stitch(self, name: str, parts: list[str], cols: list[str], anchor_keys: str | None = None) -> str:
        first = anchor_keys or parts[0]
        joins = "".join(
            f" left join {p} on {p}._country_ = k._country_ and {p}.sic = k.sic" for p in parts)
        return self.add(name, f"""
            select k._country_ as fic_code, k.sic as borrower_sic, {', '.join(cols)}
            from (select _country_, sic from {first}) k{joins}""")

    def op_covariance(self, spec: LongDiffSpec) -> tuple[str, list[str]]:
        return self.long_diff(self.opcov_by_year(), [("opcov", "OPcov")], spec, "oc")

    def dispersion(self, spec: LongDiffSpec) -> tuple[str, list[str]]:
        ms = [("sigma_mrpl", "sigma_MRPL"), ("sigma_mrpk", "sigma_MRPK"),
              ("sigma_markup", "sigma_markup")]
        return self.long_diff(self.dispersion_by_year(), ms, spec, "dp")

    def markup_decomp(self, spec: LongDiffSpec) -> tuple[str, list[str]]:
        mk = self.firm_markup()
        b = spec.base
        parts, cols = [], []
        for h in spec.horizons:
            w, bt, cr = (spec.label(t, h) for t in ("Within", "Between", "Cross"))
            parts.append(self.add(f"md_{b}_{h}", f"""
                select x._country_, x.sic,
                       sum(((x.share + h.share) / 2) * (h.markup - x.markup)) as {w},
                       sum(((x.markup + h.markup) / 2) * (h.share - x.share)) as {bt},
                       sum((h.markup - x.markup) * (h.share - x.share)) as {cr}
                from {mk} x join {mk} h
                  on x.year = {b} and h.year = {h} and h.bvd_id = x.bvd_id
                 and h._country_ = x._country_ and h.sic = x.sic
                group by x._country_, x.sic"""))
            cols += [w, bt, cr]
        # moving anchor: the first horizon with any survivor pair at all
        anchor = " ".join(f"when (select count(*) from md_{b}_{h}) > 0 then {h}" for h in spec.horizons)
        self.add(f"md_anchor_{b}", f"select case {anchor} end as a")
        keys = " union all ".join(
            f"select _country_, sic from md_{b}_{h} where (select a from md_anchor_{b}) = {h}"
            for h in spec.horizons)
        self.add(f"md_keys_{b}", keys)
        return self.stitch(f"md_ld_{b}", parts, cols, anchor_keys=f"md_keys_{b}"), cols

    def turbulence(self, spec: LongDiffSpec) -> tuple[str, list[str]]:
        s = self.shares_all()
        b = spec.base
        parts, cols = [], []
        for h in spec.horizons:
            name = spec.label("turbulence", h)
            parts.append(self.add(f"tb_{b}_{h}", f"""
                select x._country_, x.sic, sum(abs(h.share - x.share)) as {name}
                from {s} x join {s} h
                  on x.year = {b} and h.year = {h} and h.bvd_id = x.bvd_id
                 and h._country_ = x._country_ and h.sic = x.sic
                group by x._country_, x.sic"""))
            cols.append(name)
        return self.stitch(f"tb_ld_{b}", parts, cols), cols

    def concentration(self, spec: LongDiffSpec) -> tuple[str, list[str]]:
        levels, lcols = self.long_diff(self.concentration_by_year(),
                                       [("cr4", "CR4"), ("n_firms", "n_firms")], spec, "cc")
        turb, tcols = self.turbulence(spec)
        tsel = ", ".join(f"t.{c}" for c in tcols)
        lsel = ", ".join(f"l.{c}" for c in lcols)
        name = self.add(f"conc_ld_{spec.base}", f"""
            select l.fic_code, l.borrower_sic, {lsel}, {tsel}
            from {levels} l left join {turb} t
              on t.fic_code = l.fic_code and t.borrower_sic = l.borrower_sic""")
        return name, lcols + tcols

    # ---- diagnostics -----------------------------------------------------------------
    def quantile(self, col: str, q: float) -> str:
        return f"percentile_cont({q}) within group (order by {col})"

    def country_list(self, table: str) -> str:
        if self.dialect == "spark":
            return f"(select concat_ws(',', sort_array(collect_set(fic_code))) from {table})"
        return f"(select string_agg(fic_code, ',' order by fic_code) from (select distinct fic_code from {table}) d)"


def rounded(cols: list[str], bigint: set[str] = frozenset()) -> str:
    return ", ".join(c if c in bigint else f"{r6(c)} as {c}" for c in cols)


def outcome_tables(q: Sql, spec: LongDiffSpec = TREATMENT) -> dict[str, tuple[str, list[str]]]:
    return {
        "markup_decomp": q.markup_decomp(spec),
        "op_covariance": q.op_covariance(spec),
        "dispersion": q.dispersion(spec),
        "concentration": q.concentration(spec),
    }


def _n_firm_cols(cols: list[str]) -> set[str]:
    return {c for c in cols if c.startswith("LD_n_firms")}


def queries(raw_panel: str = DRIVER_PANEL_SQL, dialect: str = "duckdb") -> dict[str, str]:
    """Every registered query in naive form; doubles rounded to six decimals."""
    out: dict[str, str] = {}

    def new() -> Sql:
        return Sql(raw_panel, dialect)

    q = new()
    out["firm_panel"] = q.render(
        f"select bvd_id, _country_, sic, year, {rounded(MEASURES.split(', '))} from panel")
    q = new()
    pos = q.positive_sales()

    def lg(den: str) -> str:
        return f"case when {den} is not null and {den} > 0 then ln(sales / {den}) end"

    out["guarded_log_ratios"] = q.render(f"""
        select bvd_id, _country_, sic, year,
               {r6(lg('number_of_employees'))} as log_mrpl,
               {r6(lg('total_assets'))} as log_mrpk,
               {r6(lg('costs_of_goods_sold'))} as log_markup
        from {pos}""")
    q = new()
    s = q.shares_all()
    out["industry_share"] = q.render(
        f"select bvd_id, _country_, sic, year, {r6('sales')} as sales, {r6('share')} as share from {s}")
    q = new()
    mk = q.firm_markup()
    out["firm_markup"] = q.render(
        f"select bvd_id, _country_, sic, year, {rounded(MEASURES.split(', ') + ['markup', 'share'])} from {mk}")

    q = new()
    s = q.positive_sales()
    spec = TREATMENT
    pair_parts = " union all ".join(f"""
        select x._country_, x.sic, {h} as horizon, count(*) as n_pairs,
               count(distinct x.bvd_id) as n_firms
        from {s} x join {s} h
          on x.year = {spec.base} and h.year = {h} and h.bvd_id = x.bvd_id
         and h._country_ = x._country_ and h.sic = x.sic
        group by x._country_, x.sic""" for h in spec.horizons)
    out["survivor_pairs"] = q.render(pair_parts)

    for spec in (TREATMENT, PRESHOCK):
        for key, method in (("markup_decomp", Sql.markup_decomp), ("op_covariance", Sql.op_covariance),
                            ("dispersion", Sql.dispersion), ("turbulence", Sql.turbulence),
                            ("concentration", Sql.concentration)):
            q = new()
            table, cols = method(q, spec)
            out[f"{key}_{spec.base}"] = q.render(
                f"select fic_code, borrower_sic, {rounded(cols, _n_firm_cols(cols))} from {table}")

    q = new()
    out["opcov_by_year"] = q.render(f"select {CELL_YEAR}, {r6('opcov')} as opcov from {q.opcov_by_year()}")
    q = new()
    out["dispersion_by_year"] = q.render(
        f"select {CELL_YEAR}, {rounded(['sigma_mrpl', 'sigma_mrpk', 'sigma_markup'])} from {q.dispersion_by_year()}")
    q = new()
    q.concentration_by_year()
    out["cr4_by_year"] = q.render(f"select {CELL_YEAR}, {r6('cr4')} as cr4 from cr4_t")
    q = new()
    q.concentration_by_year()
    out["n_firms_by_year"] = q.render(f"select {CELL_YEAR}, n_firms from nf_t")
    q = new()
    out["concentration_by_year"] = q.render(
        f"select {CELL_YEAR}, {r6('cr4')} as cr4, n_firms from {q.concentration_by_year()}")

    # diagnostics over the treatment-window outcomes
    q = new()
    tables = outcome_tables(q)
    parts = []
    for name, (table, cols) in tables.items():
        for c in cols:
            v = f"cast({c} as double)"
            parts.append(f"""
                select '{name}' as outcome, '{c}' as metric, count({v}) as count,
                       count(*) - count({v}) as null_count, {r6(f'avg({v})')} as mean,
                       {r6(f'stddev_samp({v})')} as std, {r6(f'min({v})')} as min,
                       {r6(q.quantile(v, 0.25))} as p25, {r6(q.quantile(v, 0.5))} as p50,
                       {r6(q.quantile(v, 0.75))} as p75, {r6(f'max({v})')} as max,
                       cast(null as string) as min_key, cast(null as string) as max_key
                from {table}""")
        nothing = ", ".join(f"cast(null as double) as {c}" for c in ("mean", "std", "min", "p25", "p50", "p75", "max"))
        for c in ("fic_code", "borrower_sic"):
            parts.append(f"""
                select '{name}' as outcome, '{c}' as metric, count({c}) as count,
                       count(*) - count({c}) as null_count, {nothing},
                       min({c}) as min_key, max({c}) as max_key from {table}""")
    out["outcome_summary"] = q.render(" union all ".join(parts))

    q = new()
    table, cols = q.op_covariance(TREATMENT)
    out["opcov_sign_check"] = q.render(" union all ".join(
        f"select '{c}' as metric, {r6(f'avg({c})')} as mean, {r6(f'stddev_samp({c})')} as std from {table}"
        for c in cols))
    q = new()
    table, cols = q.markup_decomp(TREATMENT)
    out["within_check"] = q.render(" union all ".join(
        f"select '{c}' as metric, {r6(f'avg({c})')} as mean from {table}"
        for c in cols if "Within" in c))

    q = new()
    tables = outcome_tables(q)
    out["country_coverage"] = q.render(" union all ".join(
        f"select '{name}' as outcome, count(distinct fic_code) as n_countries, "
        f"{q.country_list(table)} as countries from {table}"
        for name, (table, _) in tables.items()))

    q = new()
    tables = outcome_tables(q)
    out["outcome_shapes"] = q.render(" union all ".join(
        f"select '{name}' as outcome, count(*) as n_rows, {len(cols) + 2} as n_columns from {table}"
        for name, (table, cols) in tables.items()))

    q = new()
    tables = outcome_tables(q, PRESHOCK)
    out["outcome_shapes_2010"] = q.render(" union all ".join(
        f"select '{name}' as outcome, count(*) as n_rows, {len(cols) + 2} as n_columns from {table}"
        for name, (table, cols) in tables.items()))
    q = new()
    table, cols = q.op_covariance(PRESHOCK)
    out["outcome_preview_2010"] = q.render(
        f"select fic_code, borrower_sic, {rounded(cols)} from {table} order by fic_code, borrower_sic limit 5")
    # the full run and the round trips give the same tables
    for spec in (TREATMENT, PRESHOCK):
        for family in ("markup_decomp", "op_covariance", "dispersion", "concentration"):
            out[f"run_{family}_{spec.base}"] = out[f"{family}_{spec.base}"]
    q = new()
    out["smoke_panel"] = q.render(
        f"select bvd_id, _country_, sic, year, {rounded(MEASURES.split(', '))} from panel where year = 2011")
    out["saved_firm_panel"] = out["firm_markup"]
    out["panel_round_trip"], out["csv_round_trip"] = out["firm_panel"], out["concentration_2010"]

    q = new()
    out["panel_count"] = q.render("select count(*) as n_rows from panel")
    return out
