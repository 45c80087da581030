"""Independent DuckDB statements for the registered queries."""

from __future__ import annotations

from checks.fixtures import AS_OF, FIRST_DUE, LAST_MONTH, NEW, OLD, PLANS, with_views
from checks.registry import CHANNELS, CUBE_ENTITY, ENTITY, FIRST_CUBE, LAST_CUBE, RUN_AT
from saldo.operators import mappings
from saldo.operators.planactual import BY_MONTH, BY_NATURE, BY_PROJECT, KEYS, MATCHED, NATURE

_oracles: dict[str, str] = {}


def all_oracles() -> dict[str, str]:
    """Statements by query name."""
    return dict(_oracles)


def _add(name: str, sql: str, extra: dict[str, str] | None = None) -> None:
    _oracles[name] = with_views(sql, extra)


def _values(rows: list[tuple], names: str) -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"select * from (values {body}) as t({names})"


# --- sources -----------------------------------------------------------------

_add("scan_project", "select l_orderkey, l_linenumber, l_shipdate, l_returnflag from lineitem")

_SPLIT = """
    select lctref, idpartida, debito as conta, 'D' as tipolancamento, valor from fx_journal
    union all select lctref, idpartida, credito, 'C', valor from fx_journal"""
_add(
    "account_allowlist",
    "select * from pernas where conta in (select conta from fx_allowlist)",
    {"pernas": _SPLIT},
)
_DOCS = """
    select cast(p_size as varchar) as fundo, lpad(cast(p_partkey%12+1 as varchar),2,'0')||'/2000' as data_referencia,
           max(p_partkey) as id from part where p_partkey%2=0 group by 1, 2"""
_add("fund_doc_select", "select * from docs", {"docs": _DOCS})
_PAIR = "cast(p_size as varchar), lpad(cast(p_partkey%12+1 as varchar),2,'0')||'/2000'"
_add(
    "fund_doc_wanted",
    " union all ".join(
        f"""select *, '{name}' as lista from docs
            where (fundo, data_referencia) in (select ({_PAIR}) from part where p_partkey%{step}=0)"""
        for name, step in (("opcional", 6), ("exigido", 10))
    ),
    {"docs": _DOCS},
)
_add(
    "fund_table_extract",
    """select fundo, data_referencia, id, cast(1 as integer) as linha, 'a.1) '||p_name||' & outros' as descricao,
              cast(cast(floor(preco) as integer)//1000 as varchar)||'.'
              ||lpad(cast(cast(floor(preco) as integer)%1000 as varchar),3,'0')||','
              ||lpad(cast(cast(preco*100 as bigint)%100 as varchar),2,'0') as valor_str
       from docs join precos on id=p_partkey
       union all
       select fundo, data_referencia, id, 2, 'b.1) '||p_brand, '' from docs join precos on id=p_partkey""",
    {
        "docs": _DOCS,
        "precos": "select p_partkey, p_name, p_brand, cast(p_retailprice as decimal(18,2)) as preco from part",
    },
)

_PLAN = "nm_ppa, nm_unidade, nm_iniciativa, nm_acao"
_NATURE = "cdg_natorcamentonvl4, nm_natorcamentonvl4"
_CUBES = {
    "cube_budget_expense": (f"{_PLAN}, {_NATURE}, vl_ano, vl_mes", "vl_ajustado", True),
    "cube_executed_expense": (f"{_PLAN}, {_NATURE}, vl_ano, vl_mes", "vl_executado", True),
    "cube_executed_entities": (
        f"nm_ppa, entidade, nm_iniciativa, nm_acao, nm_unidade, {_NATURE}, vl_ano", "vl_executado", False,
    ),
    "cube_revenue_initiative": (f"nm_ppa, nm_unidade, nm_iniciativa, {_NATURE}, vl_ano, vl_mes", "vl_ajustado", True),
    "cube_revenue_scenario": (f"nm_ppa, {_NATURE}, vl_ano, vl_mes", "vl_ajustado", True),
    "cube_account_balance": ("cdg_cdgnvl6, nm_descnvl6", "vl_contabilexecutado", True),
    "cube_expense_snapshot": (
        "fotografia, nm_iniciativa, nm_acao, nm_unidadeacao, cdg_rm, nm_cdgnatureza, nm_mes, nm_ano, nm_descnvl4",
        "vl_despesaexecutado", True,
    ),
    "cube_revenue_snapshot": (
        "fotografia, nm_iniciativa, nm_unidadeiniciativa, nm_cdgnatureza, nm_descnvl4", "vl_receitaexecutado", True,
    ),
}
# The column that each slice sums.
_SUMMED = {
    "cube_budget_expense": "vl_ajustado", "cube_executed_expense": "m_executado", "cube_executed_entities": "m_entidades",
    "cube_revenue_initiative": "m_receita", "cube_revenue_scenario": "m_cenario", "cube_account_balance": "m_contabil",
    "cube_expense_snapshot": "m_foto_despesa", "cube_revenue_snapshot": "m_foto_receita",
}


def _slice_sql(name: str) -> str:
    levels, measure, one = _CUBES[name]
    member = f"and entidade='{CUBE_ENTITY}'" if one else ""
    return f"""select {levels}, cast(sum({_SUMMED[name]}) as decimal(28,2)) as {measure} from fx_cube
            where vl_ano*100+vl_mes between {FIRST_CUBE} and {LAST_CUBE} {member}
            group by {levels} having sum({_SUMMED[name]}) is not null"""


for _name in _CUBES:
    _add(_name, _slice_sql(_name))
_add(
    "cube_slices",
    " union all by name ".join(
        f"select '{n}' as fatia, * exclude ({m}), cast({m} as decimal(28,2)) as valor from s_{n}" for n, (_, m, _) in _CUBES.items()
    ),
    {f"s_{n}": _slice_sql(n) for n in _CUBES},
)

# --- ledger ------------------------------------------------------------------

_CATEGORIES = _values(
    [(c, t.format(entity=ENTITY)) for c, t in mappings.CATEGORIES.items()], "prefixo, categoria"
)
_add(
    "account_category",
    """select codconta, categoria,
              cast(case left(codconta,1) when '6' then 1 when '3' then 2 when '5' then 2 end as integer) as receita_despesa
       from fx_account left join categorias on left(codconta,7)=prefixo""",
    {"categorias": _CATEGORIES},
)
_HIERARCHY = """
    select distinct a.codconta as cdgcontanvl6, a.reduzido as cdgreduzido, a.descricao as desccontanvl6,
           n1.codconta as cdgcontanvl1, n1.descricao as desccontanvl1, n2.codconta as cdgcontanvl2,
           n2.descricao as desccontanvl2, n3.codconta as cdgcontanvl3, n3.descricao as desccontanvl3,
           n4.codconta as cdgcontanvl4, n4.descricao as desccontanvl4, n5.codconta as cdgcontanvl5,
           n5.descricao as desccontanvl5, a.analitica, categoria,
           cast(case left(a.codconta,1) when '6' then 1 when '3' then 2 when '5' then 2 end as integer) as receita_despesa
    from fx_account a
    left join fx_account n5 on substr(a.codconta,1,10)=n5.codconta
    left join fx_account n4 on substr(a.codconta,1,7)=n4.codconta
    left join fx_account n3 on substr(a.codconta,1,5)=n3.codconta
    left join fx_account n2 on substr(a.codconta,1,3)=n2.codconta
    left join fx_account n1 on substr(a.codconta,1,1)=n1.codconta
    left join categorias on substr(a.codconta,1,7)=prefixo
    where a.analitica=1"""
_add("account_hierarchy", "select * from hierarquia", {"categorias": _CATEGORIES, "hierarquia": _HIERARCHY})
_CENTERS = """
    select u.codccusto as cc, a.campolivre as acao, p.campolivre as projeto, u.campolivre as unidade
    from fx_cost_center u left join fx_cost_center p on left(u.codccusto,5)=p.codccusto
    left join fx_cost_center a on left(u.codccusto,12)=a.codccusto where length(u.codccusto)=16"""
_add("cost_center_hierarchy", _CENTERS)

_KEPT = f"""
    select * from fx_journal where year(data)>={OLD}
    and coalesce(try_cast(codhistp as integer),0) not in (820,104,98,94,96,821)"""
_add("ledger_filters", f"select lctref, idpartida, data, codhistp, valor from ({_KEPT}) k")


def _leg(source: str, account: str, tag: str, own: int) -> str:
    raw = """case when r.lctref is not null then
                 case when r.vlrdebito<>0 and r.vlrcredito<>0 then null when r.vlrdebito<>0 then r.vlrdebito
                      when r.vlrcredito<>0 then r.vlrcredito else 0 end
             else j.valor end"""
    return f"""
        select right(r.codgerencial,16) as cc, j.{account} as conta,
               cast(case when c.natureza={own} then {raw} else -1*({raw}) end as decimal(18,2)) as valor,
               r.idrateio, j.lctref, j.idpartida, m.idmov, m.codtmv, m.campolivre1 as contrato, f.nome as fornecedor,
               m.codusuario, m.dataemissao, j.complemento, j.data, '{tag}' as tipolancamento, c.natureza
        from {source} j
        left join fx_allocation r on j.lctref=r.lctref and j.idpartida=r.idpartida and j.{account}=r.codconta
        left join fx_movement m on j.integrachave=cast(m.idmov as varchar)
        join fx_account c on c.codconta=j.{account}
        left join fx_counterparty f on m.codcfo=f.codcfo"""


def _both(source: str) -> str:
    return _leg(source, "debito", "D", 1) + " union all " + _leg(source, "credito", "C", 0)


_add(
    "ledger_value_rule",
    "select lctref, idpartida, tipolancamento, idrateio, conta, natureza, valor from pernas",
    {"pernas": _both("fx_journal").replace("left join fx_movement m on j.integrachave=cast(m.idmov as varchar)",
                                            "left join fx_movement m on m.idmov is null")},
)
_LEGS = {"mantidas": _KEPT, "pernas": _both("mantidas")}
_add("ledger_legs", "select * exclude (natureza) from pernas", _LEGS)
_add("ledger_legs_bucketed", "select * exclude (natureza) from pernas", _LEGS)
_add(
    "national_code",
    """select lctref, idpartida, tipolancamento, conta, nacional
       from pernas left join fx_national on conta=codconta""",
    {"pernas": _SPLIT},
)
_add(
    "ledger_fact",
    """select o.* exclude (natureza), k.acao, k.projeto, k.unidade,
              h.desccontanvl6 as descnvl6, h.desccontanvl5 as descnvl5, h.desccontanvl4 as descnvl4,
              h.desccontanvl3 as descnvl3, h.desccontanvl2 as descnvl2, h.desccontanvl1 as descnvl1,
              h.categoria, h.cdgcontanvl4, n.nacional
       from pernas o join fx_allowlist l on o.conta=l.conta left join centros k on o.cc=k.cc
       left join hierarquia h on h.cdgcontanvl6=o.conta left join fx_national n on n.codconta=o.conta""",
    {**_LEGS, "centros": _CENTERS, "categorias": _CATEGORIES, "hierarquia": _HIERARCHY},
)

_add(
    "concat_key",
    "select cc, upper(coalesce(projeto,'')||coalesce(acao,'')||coalesce(unidade,'')) as chave_concat from centros",
    {"centros": _CENTERS},
)

# --- budget ------------------------------------------------------------------


def _folded(parts: str) -> str:
    """Without case and accents; the barred l has no accent that could be taken off."""
    return f"rtrim(replace(strip_accents(lower(concat({parts}))),'ł','l'))"


_MAP = {
    "centros": _CENTERS,
    "mapa": """
        select cc, cast(ano as integer) as ano,
               case when lower(projeto)='middle east' then 'Oriente Médio' else projeto end as projeto, acao, unidade
        from fx_year_map left join centros using (cc)""",
    "chaves": f"select {_folded('ano,projeto,acao,unidade')} as chave, cc as nm_cc from mapa",
    "linhas": f"select *, {_folded('vl_ano,nm_iniciativa,nm_acao,nm_unidade')} as chave from fx_budget",
}
_add("budget_cc_map", "select distinct * from mapa", _MAP)
_add(
    "collated_key_join",
    """select min(concat(vl_ano,nm_iniciativa,nm_acao,nm_unidade)) as chave, nm_cc, count(*) as linhas
       from linhas join chaves using (chave) group by linhas.chave, nm_cc""",
    _MAP,
)
_add(
    "budget_with_cc",
    """select linhas.* exclude (chave), nm_cc from linhas left join chaves on linhas.chave=chaves.chave
       where nm_iniciativa not ilike 'CANCELADO%'""",
    _MAP,
)
_LABELS_IN = ", ".join(f"'{p}'" for p in PLANS.values())
_PLANNED = f"select * from fx_plan where nm_ppa in ({_LABELS_IN}) and vl_mes<={LAST_MONTH}"
_add("plan_filter", _PLANNED)

# --- receivables -------------------------------------------------------------

_JOINED = """
    select idlan, a.idmov, numerodocumento as recibo, descstatuslcto, datavencimento, idformapagto, descstatuscnab,
           descstatusexportcontabilidade, coddepartamento, codcxa, descpagarreceber, codtdo, datacriacao, databaixa,
           datacancelamento, historico, valororiginal, valorbaixado, valorjuros, valordesconto, a.dataemissao,
           dataprevbaixa, a.codcfo, valorop4bx as txcartao, codautorizacaovenda, descricao_tipo_pagamento,
           codeventobaixa, codccusto, b.valorbrutoorig, b.codtmv, a.pagrec
    from fx_instalment a left join fx_movement b on a.idmov=b.idmov"""
_DUE = f"datavencimento between date '{FIRST_DUE}' and date '{AS_OF}' and pagrec='1'"
_KEPT_DEBTS = """codtdo not in ('030') and codcxa not like '22.420-0'
    and historico not ilike 'Dev. adiantamento  viagem' and descstatuslcto <> 'Cancelado'"""
_add("receivables_base", f"select * exclude (pagrec) from titulos where {_DUE}", {"titulos": _JOINED})
_add(
    "receivables_bucketed",
    f"select * exclude (pagrec) replace (cast(valorbrutoorig as decimal(18,2)) as valorbrutoorig) from titulos where {_DUE}",
    {"titulos": _JOINED},
)
_add(
    "receivables_filters",
    f"select * exclude (pagrec) from titulos where {_DUE} and {_KEPT_DEBTS}",
    {"titulos": _JOINED},
)

# --- standardise, quality, tables --------------------------------------------

_add(
    "rename_standard",
    """select idmov as cdg_idmov, codtmv as cdg_codtmv, codcfo as cdg_codcfo, campolivre1,
              codusuario as nm_codusuario, dataemissao as nm_dataemissao, valorbrutoorig as vl_bruto
       from fx_movement""",
)
_add(
    "rename_fallback",
    """select o_orderkey as valor_r, o_custkey as foto_nome, o_orderstatus as "key",
              o_orderpriority as "situação_do_título" from orders""",
)
_LOCAL = "coalesce(try_cast(replace(replace({c},'.',''),',','.') as double),0)"
_add("br_number_parse", f"select id, {_LOCAL.format(c='valor_str')} as vl_valor from fx_text_amount")
_add(
    "br_number_column",
    f"""select id, case when (select max(contains(vl_valor,',')) from fx_mixed_amount)
                   then {_LOCAL.format(c='vl_valor')} else coalesce(try_cast(vl_valor as double),0) end as vl_valor
        from fx_mixed_amount""",
)
_add(
    "decimal_scale",
    """select l_orderkey, l_linenumber, cast(vl_preco as decimal(38,8)) as vl_preco,
              cast((l_linenumber+l_linenumber%2)*0.00000001 as decimal(38,8)) as vl_empate,
              case when l_linenumber>3 then cast(l_orderkey as decimal(38,8)) end as vl_texto,
              cast(taxa as decimal(38,8)) as taxa, vl_inteiro from fx_typed""",
)
_add(
    "int_columns",
    """select id, case when id%5=0 or id%7=0 then 0 else cast(left(vl_ano,4) as integer) end as vl_ano,
              cast(vl_mes-0.5 as integer) as vl_mes from fx_period""",
)
_add(
    "quality_metrics",
    """select count(*) as total_linhas, cast(10 as integer) as total_colunas,
              count(*)-count(nm_cc) as total_nulos,
              '{"nm_ppa":"string","nm_unidade":"string","nm_iniciativa":"string","nm_acao":"string",'
              ||'"nm_cc":"string","cdg_natorcamentonvl4":"string","nm_natorcamentonvl4":"string",'
              ||'"vl_ano":"int","vl_mes":"int","vl_ajustado":"decimal(38,8)"}' as tipos_inferidos
       from fx_plan""",
)
_add(
    "numeric_stats",
    " union all ".join(
        f"""select '{c}' as coluna, cast(sum({c}) as double) as soma_total,
                   cast(sum({c}) as double)/count({c}) as media, cast(max({c}) as double) as maximo,
                   cast(min({c}) as double) as minimo from lineitem"""
        for c in ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    ),
)
_add(
    "fund_kpis",
    """select cast(sum(v) filter (substr(d,1,2)='a.' and substr(d,3,1) between '1' and '7') as decimal(38,8))
                  as soma_inadimplentes_ate_360_dias,
              cast(sum(v) filter (substr(d,1,2)='b.' and substr(d,3,1) between '1' and '7') as decimal(38,8))
                  as soma_pagos_antecipadamente_ate_360_dias,
              cast(sum(v) filter (substr(d,3,1) between '1' and '7') as decimal(38,8)) as soma_total
       from valores""",
    {
        "valores": """select trim(descricao) as d, coalesce(try_cast(replace(replace(valor_str,'.',''),',','.')
                      as decimal(28,8)),0) as v from fx_text_amount"""
    },
)
_add("load_replace", "select * replace (cast(vl_ajustado as decimal(38,8)) as vl_ajustado) from fx_plan")
_add("read_back", "select * from fx_movement")
_add("read_through", "select ano, count(*) as centros from fx_year_map group by ano")
_add(
    "audit_append",
    f"""select 'orcado' as nome_processo, '{RUN_AT}' as data_execucao, count(*) as total_linhas,
               cast(10 as integer) as total_colunas, count(*)-count(nm_cc) as total_nulos, count(*) as linhas_json,
               cast(sum(vl_ano) as double) as soma_anos, cast(null as double) as maximo_ids,
               cast(null as double) as soma_faixas
        from fx_plan
        union all select 'titulos', '{RUN_AT}', count(*), 3, 0, count(*), null, cast(max(id) as double),
               cast(sum(v) filter (substr(trim(descricao),3,1) between '1' and '7') as double)
        from (select *, coalesce(try_cast(replace(replace(valor_str,'.',''),',','.') as decimal(28,8)),0) as v
              from fx_text_amount)""",
)
_STORED = f"""select idlan as cdg_idlan, idmov as cdg_idmov, recibo as nm_recibo, descstatuslcto as nm_descstatuslcto,
               datavencimento as dt_datavencimento, databaixa as dt_databaixa,
               cast(valororiginal as decimal(38,8)) as vl_valororiginal,
               cast(valorbaixado as decimal(38,8)) as vl_valorbaixado, cast(txcartao as decimal(38,8)) as vl_txcartao,
               cast(valorbrutoorig as decimal(38,8)) as vl_bruto, codtmv as cdg_codtmv, historico as nm_historico
        from titulos where {_DUE} and {_KEPT_DEBTS}"""
_COUNTED = {
    "fatofechamento": """select count(*) from pernas o join fx_allowlist l on o.conta=l.conta
                         left join centros k on o.cc=k.cc
                         left join hierarquia h on h.cdgcontanvl6=o.conta left join fx_national n on n.codconta=o.conta""",
    "plancc": """select count(*) from linhas left join chaves on linhas.chave=chaves.chave
                 where nm_iniciativa not ilike 'CANCELADO%'""",
    "orcado": f"select count(*) from ({all_oracles()['cube_budget_expense']})",
}
_add(
    "refresh_dataset",
    "select 'inadim' as dataset, *, cast(null as bigint) as linhas from guardado"
    + "".join(
        f" union all by name select '{name}' as dataset, ({count}) as linhas" for name, count in _COUNTED.items()
    ),
    {
        "titulos": _JOINED, "guardado": _STORED, **_MAP, **_LEGS,
        "centros": _CENTERS, "categorias": _CATEGORIES, "hierarquia": _HIERARCHY,
    },
)

_add(
    "standardized_datasets",
    """select 'titulos' as dataset, id, cast(v as decimal(38,8)) as vl_valor, cast(null as integer) as vl_ano,
              (select count(*) from fx_text_amount) as linhas, cast(0 as bigint) as nulos
       from (select *, coalesce(try_cast(replace(replace(valor_str,'.',''),',','.') as decimal(28,8)),0) as v from fx_text_amount)
       union all
       select 'periodos', id, null, case when id%5=0 or id%7=0 then 0 else cast(left(vl_ano,4) as integer) end,
              (select count(*) from fx_period), 0 from fx_period""",
)

# --- plan against actual -----------------------------------------------------

_CODES = _values(list(mappings.ACCOUNT_RECODES.items()), "prefixo, natureza")
_LABELS = _values(
    [(c, f"N4 {c}", label) for (c, _), label in mappings.NATURE_LABELS.items()], "prefixo, descricao, rotulo"
)
_RECODED = """
    select f.* exclude (nm_descnvl4), coalesce(natureza,left(nm_conta,7)) as cdg_natorcamentonvl4,
           coalesce(rotulo,nm_descnvl4) as nm_descnvl4
    from fx_fact f left join codigos on left(nm_conta,7)=codigos.prefixo
    left join rotulos on left(nm_conta,7)=rotulos.prefixo and upper(nm_descnvl4)=descricao"""
_EXECUTED = f"""
    select 'PPA '||year(nm_data) as nm_ppa, min(nm_unidade) as nm_unidade, min(nm_projeto) as nm_iniciativa,
           min(nm_acao) as nm_acao, cdg_natorcamentonvl4, min(nm_descnvl4) as nm_descnvl4, min(nm_cc) as nm_cc, cast(year(nm_data) as integer) as vl_ano, cast(month(nm_data) as integer) as vl_mes,
           cast(sum(vl_valor) as decimal(28,2)) as vl_valor
    from recodificado where year(nm_data) in ({OLD},{NEW}) and month(nm_data)<={LAST_MONTH} and nm_descnvl1='DESPESAS'
    group by year(nm_data), month(nm_data), cdg_natorcamentonvl4, upper(rtrim(nm_unidade)), upper(rtrim(nm_projeto)),
             upper(rtrim(nm_acao)), upper(rtrim(nm_descnvl4)), upper(rtrim(nm_cc))"""
_NAMED = ["nm_iniciativa", "nm_acao", "nm_unidade", "nm_cc", NATURE]


def _same(key: str, alias: str = "") -> str:
    return f"upper(rtrim({alias}{key}))" if key in _NAMED else alias + key


_SHOWN_KEYS = ", ".join(f"min({k}) as {k}" for k in KEYS)
_RECODE_CTES = {"codigos": _CODES, "rotulos": _LABELS, "recodificado": _RECODED}
_ON_P = " and ".join(f"{_same(k, 'c.')}={_same(k, 'p.')}" for k in MATCHED)
_ON_E = " and ".join(f"{_same(k, 'c.')}={_same(k, 'e.')}" for k in MATCHED)
_K = ", ".join(KEYS)
_REPORT = {
    **_RECODE_CTES,
    "executado": _EXECUTED,
    "planejado": _PLANNED,
    "chaves": f"""select {_SHOWN_KEYS} from (select {_K} from planejado union select {_K} from executado)
        group by {", ".join(_same(k) for k in KEYS)}""",
    "relatorio": f"""
        select c.*, upper(coalesce(p.nm_natorcamentonvl4,e.nm_descnvl4)) as {NATURE},
               coalesce(p.vl_ajustado,0) as vl_ajustado, coalesce(e.vl_valor,0) as vl_valor
        from chaves c left join planejado p on {_ON_P} left join executado e on {_ON_E}""",
}


def _totals(by: list[str]) -> str:
    present = " and ".join(f"{k} is not null" for k in by)
    shown = ", ".join(f"min({k}) as {k}" for k in by)
    return f"""select {shown}, cast(sum(vl_ajustado) as decimal(38,2)) as planejado,
                      cast(sum(vl_valor) as decimal(38,2)) as executado
               from relatorio where {present} group by {", ".join(_same(k) for k in by)}"""


_TOTALS = {
    **_REPORT,
    "mensal": _totals(BY_MONTH),
    "naturezas": _totals(BY_NATURE),
    "projetos": _totals(BY_PROJECT),
}
_add("recode_account", "select nm_conta, cdg_natorcamentonvl4, nm_descnvl4, vl_valor from recodificado", _RECODE_CTES)
_add("recode_account_sql", "select nm_conta, cdg_natorcamentonvl4, nm_descnvl4, vl_valor from recodificado", _RECODE_CTES)
_add("executed_fact", "select * from executado", {**_RECODE_CTES, "executado": _EXECUTED})
_add(
    "executed_in_wanted_years",
    "select * replace (cast(vl_valor as decimal(38,8)) as vl_valor) from executado",
    {**_RECODE_CTES, "executado": _EXECUTED},
)
_add("plan_actual_keys", "select * from chaves", _REPORT)
_add(
    "plan_actual",
    """select * replace (cast(vl_ajustado as decimal(18,2)) as vl_ajustado, cast(vl_valor as decimal(28,2)) as vl_valor)
       from relatorio""",
    _REPORT,
)
_add("plan_actual_month", "select * from mensal", _TOTALS)
_add("plan_actual_nature", "select * from naturezas", _TOTALS)
_add("plan_actual_project", "select * from projetos", _TOTALS)
_add(
    "plan_actual_nested",
    """select nm_unidade, nm_iniciativa, '{'||string_agg('"'||vl_ano||'":{"planejado":'||planejado||',"executado":'
              ||executado||'}', ',' order by vl_ano)||'}' as anos from projetos group by 1, 2""",
    _TOTALS,
)
_add(
    "json_payload",
    f"""select 'mensal' as secao, '{{"nm_unidade":"'||nm_unidade||'","vl_ano":'||vl_ano||',"vl_mes":'||vl_mes
               ||',"planejado":'||planejado||',"executado":'||executado||'}}' as registro from mensal
        union all select 'natureza', '{{"nm_unidade":"'||nm_unidade||'","vl_ano":'||vl_ano||',"{NATURE}":"'||{NATURE}
               ||'","planejado":'||planejado||',"executado":'||executado||'}}' from naturezas
        union all select 'projeto', '{{"nm_unidade":"'||nm_unidade||'","nm_iniciativa":"'||nm_iniciativa
               ||'","vl_ano":'||vl_ano||',"planejado":'||planejado||',"executado":'||executado||'}}' from projetos""",
    _TOTALS,
)

# --- coverage and dashboard --------------------------------------------------


def _side(name: str, condition: str) -> str:
    return f"""select min(nm_unidade) as nm_unidade, upper(rtrim(nm_unidade)) as u,
                      cast(year(nm_data) as integer) as ano, sum(vl_valor) as {name} from fx_fact
               where year(nm_data) in ({OLD},{NEW}) and month(nm_data)<={LAST_MONTH} and {condition} group by 2, 3"""


_COVERAGE = {
    "despesas": _side("despesa", "nm_descnvl1 ilike 'desp%'"),
    "receitas": _side("receita", "nm_descnvl3 in ('REC A','REC B')"),
    "cobertura": """
        select trim(least(a.nm_unidade,b.nm_unidade)) as unidade, coalesce(a.ano,b.ano) as ano,
               cast(coalesce(despesa,0) as double) as despesa, cast(coalesce(receita,0) as double) as receita,
               cast(coalesce(receita,0)-coalesce(despesa,0) as double) as resultado_liquido,
               case when coalesce(despesa,0)>0
                    then cast(coalesce(receita,0) as double)/cast(despesa as double)*100 else 0 end as indice_cobertura
        from despesas a full join receitas b on a.u=b.u and a.ano=b.ano""",
}
_add("coverage", "select * from cobertura", _COVERAGE)
_add(
    "telemetry",
    """select nome_processo, strftime(data_execucao,'%Y-%m-%d %H:%M:%S') as data_execucao, total_linhas,
              total_colunas, total_nulos,
              case when detalhes_json like '{"kpis%' then detalhes_json else '{}' end as detalhes from fx_audit""",
)
_AUDITED = {
    "lidos": """
        select nome_processo, data_execucao, case when json_valid(detalhes_json) then detalhes_json::json else '{}'::json end as d
        from fx_audit_full"""
}
_add(
    "telemetry_metrics",
    """select nome_processo, data_execucao, try_cast(d->>'$.kpis_gerais.total_linhas' as bigint) as linhas,
              try_cast(d->>'$.kpis_gerais.total_colunas' as integer) as colunas,
              try_cast(d->>'$.qualidade_dados.total_nulos' as bigint) as nulos,
              try_cast(d->>'$.kpis_gerais.soma_total' as double) as soma_faixas from lidos""",
    _AUDITED,
)
_add(
    "telemetry_statistics",
    "select nome_processo, data_execucao, c as coluna, "
    + ", ".join(f"try_cast(d->'$.estatisticas_numericas'->c->>'{n}' as double) as {n}" for n in ("soma_total", "media", "maximo", "minimo"))
    + " from (select *, unnest(json_keys(d, '$.estatisticas_numericas')) as c from lidos)",
    _AUDITED,
)
_add(
    "telemetry_schema",
    "select distinct nome_processo, 'OBJECT<kpis_gerais: OBJECT<total_linhas: BIGINT>>' as esquema from fx_audit",
)
_MONTHS = " ".join(f"when {n} then '{t}'" for n, t in mappings.MONTH_NAMES.items())
_add("units", "select distinct nm_unidade from mensal", _TOTALS)
_add(
    "unit_month_series",
    f"""select nm_unidade, vl_ano, vl_mes, case vl_mes {_MONTHS} end as nome,
               cast(floor(planejado+0.5) as bigint) as planejado, cast(floor(executado+0.5) as bigint) as executado
        from mensal""",
    _TOTALS,
)


def _change(old: str, new: str) -> str:
    return f"""case when {old}>0 then (cast({new} as double)-cast({old} as double))/cast({old} as double)*100
                    when {new}>0 then 100.0::double else 0.0::double end"""


def _year_sum(value: str, year: int) -> str:
    return f"coalesce(sum({value}) filter (vl_ano={year}),0)"


_add(
    "project_yoy",
    f"""select *, {_change(f"planejado_{OLD}", f"planejado_{NEW}")} as var_planejado,
               {_change(f"executado_{OLD}", f"executado_{NEW}")} as var_executado from lado""",
    {
        **_TOTALS,
        "lado": "select nm_unidade, nm_iniciativa, "
        + ", ".join(
            f"cast({_year_sum(v, y)} as decimal(38,2)) as {v}_{y}" for y in (OLD, NEW) for v in ("planejado", "executado")
        )
        + " from projetos group by 1, 2",
    },
)
_NATURES = {
    **_TOTALS,
    "lado": f"select nm_unidade, {NATURE} as nome_completo, "
    + ", ".join(
        f"cast(floor({_year_sum('executado', y)}+0.5) as bigint) as executado_{y}" for y in (OLD, NEW)
    )
    + " from naturezas group by 1, 2",
}
_add(
    "nature_yoy",
    f"""select nm_unidade, case when length(nome_completo)>20 then substr(nome_completo,1,20)||'...'
                                else nome_completo end as nome,
               nome_completo, executado_{OLD}, executado_{NEW},
               {_change(f"executado_{OLD}", f"executado_{NEW}")} as delta from lado""",
    _NATURES,
)
_add(
    "nature_scaled",
    f"""select nm_unidade, nome_completo, executado_{OLD}::double/topo*100 as posicao_{OLD},
               executado_{NEW}::double/topo*100 as posicao_{NEW}
        from lado join (select nm_unidade, greatest(max(greatest(executado_{OLD},executado_{NEW})),1) as topo
                        from lado group by 1) t using (nm_unidade)""",
    _NATURES,
)


def _coverage_of(year: int, value: str) -> str:
    return f"coalesce(max({value}) filter (ano={year}),0)"


_add(
    "coverage_unit",
    "select unidade, "
    + ", ".join(
        f"""cast(floor({_coverage_of(y, 'despesa')}+0.5) as bigint) as despesa_{y},
            cast(floor({_coverage_of(y, 'receita')}+0.5) as bigint) as receita_{y},
            round({_coverage_of(y, 'indice_cobertura')},2) as cobertura_{y}"""
        for y in (OLD, NEW)
    )
    + " from cobertura where unidade is not null group by unidade",
    _COVERAGE,
)
_add(
    "coverage_ranking",
    f"""select *, case when cobertura_{OLD}>0 then cobertura_{NEW}-cobertura_{OLD} else 0 end as variacao,
               row_number() over (order by cobertura_{NEW} desc, unidade) as posicao
        from (select unidade, {_coverage_of(OLD, 'indice_cobertura')} as cobertura_{OLD},
                     {_coverage_of(NEW, 'indice_cobertura')} as cobertura_{NEW} from cobertura group by 1) u""",
    _COVERAGE,
)

# --- delinquency -------------------------------------------------------------

_BASE = {
    "titulos": _JOINED,
    "base": f"""
        select idlan as cdg_idlan, coalesce(cast(idmov as varchar),'<NA>') as cdg_idmov, codtmv as cdg_codtmv,
               descstatuslcto as nm_descstatuslcto, historico as nm_historico,
               cast(datavencimento as timestamp) as dt_datavencimento, cast(databaixa as timestamp) as dt_databaixa,
               cast(datacriacao as timestamp) as dt_datacriacao,
               cast(coalesce(valorbrutoorig,0) as decimal(38,8)) as vl_bruto,
               cast(coalesce(valororiginal,0) as decimal(38,8)) as vl_valororiginal,
               cast(coalesce(valorbaixado,0) as decimal(38,8)) as vl_valorbaixado,
               cast(year(datavencimento) as integer) as ano_venc, cast(month(datavencimento) as integer) as mes_venc
        from titulos where year(datavencimento) in ({OLD},{NEW})""",
}
_LATE = """(coalesce(dt_databaixa>dt_datavencimento,false)
            or (dt_databaixa is null and dt_datavencimento<{limit}))"""
_FLAGS = {
    **_BASE,
    "cortes": f"""select *, case when ano_venc={OLD} then timestamp '{AS_OF}' - interval 1 year
                                 else timestamp '{AS_OF}' end as limite from base""",
    "marcas": f"""select *, {_LATE.format(limit='limite')} as is_inadimplente,
                         case when lower(trim(nm_descstatuslcto))='baixado' and dt_databaixa<=limite
                              then 'Baixado' else 'Em Aberto' end as status_simplificado from cortes""",
}
_NOW = {
    **_BASE,
    "marcas": f"""select *, {_LATE.format(limit=f"timestamp '{AS_OF}'")} as is_inadimplente,
                         case when lower(trim(nm_descstatuslcto))='baixado' then 'Baixado' else 'Em Aberto' end
                             as status_simplificado from base""",
}
_SHOWN = "cdg_idlan, cdg_idmov, ano_venc, mes_venc"
_add("delinq_base", f"select {_SHOWN}, vl_bruto, vl_valororiginal, vl_valorbaixado, cdg_codtmv from base", _BASE)
_add("delinq_flags", f"select {_SHOWN}, is_inadimplente, status_simplificado from marcas", _FLAGS)
_add("delinq_flags_sql", f"select {_SHOWN}, is_inadimplente, status_simplificado from marcas", _FLAGS)
_add("delinq_flags_now", f"select {_SHOWN}, is_inadimplente, status_simplificado from marcas", _NOW)
_COUNTS = {
    **_FLAGS,
    "contagem": f"""
        select cast(month(dt_datacriacao) as integer) as mes, cdg_codtmv as tipo_mov,
               count(distinct cdg_idmov) filter (ano_venc={OLD}) as "{OLD}",
               count(distinct cdg_idmov) filter (ano_venc={NEW}) as "{NEW}"
        from marcas where dt_datacriacao<=limite and cdg_codtmv is not null group by 1, 2""",
}
_add("invoices_by_channel", "select * from contagem", _COUNTS)
_add("invoices_by_channel_bitmap", "select * from contagem", _COUNTS)
_add(
    "invoices_by_year_bitmap",
    """select ano_venc, cdg_codtmv as tipo_mov, count(distinct cdg_idmov) as notas
       from marcas where dt_datacriacao<=limite and cdg_codtmv is not null
       group by grouping sets ((ano_venc), (ano_venc, cdg_codtmv))""",
    _FLAGS,
)
_DAY = "dia::timestamp"
_add(
    "delinq_daily",
    f"""select tipo_mov, dia, count(cdg_idlan) as parcelas, cast(coalesce(sum(vl_valororiginal),0) as decimal(38,8)) as valor
        from (select distinct cdg_codtmv as tipo_mov from base) c
        cross join (select cast(unnest(generate_series(timestamp '{AS_OF}' - interval 1 year, timestamp '{AS_OF}', interval 1 day)) as date) as dia) d
        left join base on cdg_codtmv is not distinct from tipo_mov and {_LATE.format(limit=_DAY)}
             and not coalesce(lower(trim(nm_descstatuslcto))='baixado' and dt_databaixa<={_DAY}, false)
        group by 1, 2""",
    _BASE,
)
_add("invoices_no_outlier", "select * from contagem where tipo_mov not in ('2.1.1','2.1.13')", _COUNTS)
_add(
    "channel_matrix",
    " union all ".join(
        f"select cast({y} as integer) as ano, mes, "
        + ", ".join(
            f"""cast(coalesce(sum("{y}") filter (tipo_mov='{c}'),0) as bigint) as canal_{c.replace('.', '_')}"""
            for c in CHANNELS
        )
        + f""", cast(coalesce(sum("{y}") filter (tipo_mov not in ({', '.join(repr(c) for c in CHANNELS)})),0) as bigint)
              as canal_outros"""
        + " from contagem group by mes"
        for y in (OLD, NEW)
    ),
    _COUNTS,
)
_add(
    "open_by_channel",
    f"""select mes_venc as mes, cdg_codtmv as tipo_mov,
               cast(coalesce(sum(vl_valororiginal) filter (ano_venc={OLD}),0) as decimal(38,8)) as "{OLD}",
               cast(coalesce(sum(vl_valororiginal) filter (ano_venc={NEW}),0) as decimal(38,8)) as "{NEW}"
        from marcas where status_simplificado='Em Aberto' and cdg_codtmv is not null group by 1, 2""",
    _FLAGS,
)
_add(
    "channel_impact",
    """select ano_venc as "Ano Vencimento", cdg_codtmv as "Canal (CODTMV)",
              sum(vl_valororiginal) as "Valor Total Acumulado em Aberto (R$)",
              max(vl_valororiginal) as "Maior Boleto Único do Canal (R$)", count(cdg_idlan) as "Qtd Parcelas Vencidas"
       from marcas where status_simplificado='Em Aberto' and cdg_codtmv is not null group by 1, 2""",
    _FLAGS,
)


def _shown(names: dict[str, str]) -> str:
    return ", ".join(f'{column} as "{label}"' for column, label in names.items())


def _order(names: dict[str, str]) -> str:
    rest = ", ".join(f"{c} nulls first" for c in names if c != "vl_bruto")
    return f"vl_bruto desc, cdg_idlan, {rest}"


_add(
    "top_open",
    f"""select ano_venc, cast(n as integer) as posicao, {_shown(mappings.TOP_OPEN_NAMES)}
        from (select *, row_number() over (partition by ano_venc order by {_order(mappings.TOP_OPEN_NAMES)}) as n
              from marcas where status_simplificado='Em Aberto') m where n<=10""",
    _FLAGS,
)


def _timeline(value: str, kind: str) -> str:
    cells = {
        mappings.PAID_ON_TIME: "dt_databaixa<=dt_datavencimento",
        mappings.PAID_LATE: "dt_databaixa>dt_datavencimento",
        mappings.STILL_OPEN: "dt_databaixa is null",
    }
    columns = ", ".join(
        f'cast(coalesce({value} filter ({test}),0) as {kind}) as "{name}"' for name, test in cells.items()
    )
    return f"""select ano_venc*100+mes_venc as periodo_ordenado, mes_venc||'/'||ano_venc as periodo_nome, {columns}
               from base group by 1, 2"""


_add("cash_timeline", _timeline("sum(vl_valororiginal)", "decimal(38,8)"), _BASE)
_add("cash_timeline_sql", _timeline("sum(vl_valororiginal)", "decimal(38,8)"), _BASE)
_add("count_timeline", _timeline("count(cdg_idlan)", "bigint"), _BASE)


def _pct(part: str, whole: str) -> str:
    return f"round_even(cast({part} as double)/nullif(cast({whole} as double),0)*100*100,0)/100"


def _by_count(source: str) -> str:
    return f"""select *, {_pct('qtd_baixado', 'total_parcelas')} as pct_baixado_qtd,
                      {_pct('qtd_aberto', 'total_parcelas')} as pct_aberto_qtd
               from (select ano_venc, mes_venc, count(cdg_idlan) filter (status_simplificado='Baixado') as qtd_baixado,
                            count(cdg_idlan) filter (status_simplificado='Em Aberto') as qtd_aberto,
                            count(cdg_idlan) as total_parcelas from {source} group by 1, 2) c"""


_ONCE = """
    select ano_venc, mes_venc, sum(vl_bruto) as total_faturamento_bruto
    from (select distinct on (ano_venc, mes_venc, cdg_idmov) ano_venc, mes_venc, cdg_idmov, vl_bruto
          from {source} order by ano_venc, mes_venc, cdg_idmov, cdg_idlan, vl_bruto) f group by 1, 2"""


def _by_value(source: str, paid: str) -> str:
    return f"""select *, {_pct('valor_baixado', 'total_faturamento_bruto')} as pct_baixado_val,
                      {_pct('valor_aberto', 'total_faturamento_bruto')} as pct_aberto_val
               from ({_ONCE.format(source=source)}) g join
                    (select ano_venc, mes_venc, coalesce({paid},0)::decimal(38,8) as valor_baixado,
                            coalesce(sum(vl_valororiginal) filter (status_simplificado='Em Aberto'),0)::decimal(38,8)
                                as valor_aberto from {source} group by 1, 2) v using (ano_venc, mes_venc)"""


_LATE_ONLY = {**_NOW, "atrasados": "select * from marcas where is_inadimplente"}
_add("share_by_count", _by_count("marcas"), _NOW)
_add("gross_dedup", _ONCE.format(source="marcas"), _NOW)
_add("share_by_value", _by_value("marcas", "sum(vl_valorbaixado)"), _NOW)
_add("delinq_share_count", _by_count("atrasados"), _LATE_ONLY)
_add(
    "delinq_share_value",
    _by_value("atrasados", "sum(vl_valorbaixado) filter (status_simplificado='Baixado')"),
    _LATE_ONLY,
)


def _audit(name: str, condition: str) -> str:
    return f"""
        select '{name}' as lista, cast(n as integer) as posicao, total, {_shown(mappings.AUDIT_NAMES)}
        from (select *, count(*) over () as total, row_number() over (order by {_order(mappings.AUDIT_NAMES)}) as n
              from atrasados where {condition}) a where n<=100"""


_add(
    "delinq_audit",
    " union all ".join(
        [
            _audit(f"inadimplentes_{OLD}", f"ano_venc={OLD}"),
            _audit(f"inadimplentes_{NEW}", f"ano_venc={NEW}"),
            _audit(f"pagos_com_atraso_{NEW}", f"ano_venc={NEW} and status_simplificado='Baixado'"),
        ]
    ),
    _LATE_ONLY,
)

# --- budget and ledger -------------------------------------------------------

_add(
    "top_cost_centers",
    """select nm_cc, cast(sum(vl_valor) as decimal(28,2)) as vl_valor from fx_fact where nm_cc is not null
       group by nm_cc order by vl_valor desc, nm_cc limit 10""",
)
_JOIN = f"""
    select p.nm_cc, p.vl_ano, p.cdg_natorcamentonvl4, p.nm_natorcamentonvl4, p.vl_mes, p.vl_ajustado, f.ano_fatos,
           f.nm_conta, f.vl_valor, f.nm_data, f.nm_projeto, f.nm_acao, f.nm_unidade, f.nm_descnvl4, f.nm_descnvl3,
           f.nm_descnvl1, f.cdg_codtmv, f.cdg_contrato, f.nm_fornecedor, f.nm_descnvl6, f.nm_descnvl5, f.nm_descnvl2
    from fx_plan p left join
         (select *, cast(year(nm_data) as integer) as ano_fatos from fx_fact where year(nm_data) in ({OLD},{NEW})) f
         on p.nm_cc is not distinct from f.nm_cc and p.vl_ano=f.ano_fatos"""
_add("budget_ledger_join", _JOIN)
_add(
    "budget_ledger_nature",
    """select nm_natorcamentonvl4, cast(sum(coalesce(vl_valor,0)) as decimal(38,2)) as vl_valor,
              cast(sum(vl_ajustado) as decimal(38,2)) as vl_ajustado
       from juncao where nm_natorcamentonvl4 is not null group by 1""",
    {"juncao": _JOIN},
)
