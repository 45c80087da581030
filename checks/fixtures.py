"""Input views over the test tables, in SQL that Spark and DuckDB both read.

Each text may use base tables and other views. ``view`` builds one for Spark;
``with_views`` prefixes a DuckDB statement with the views it mentions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BASE = "region|nation|supplier|customer|part|orders|lineitem"
OLD, NEW, LAST_MONTH, AS_OF, FIRST_DUE = 1999, 2000, 3, "2000-06-30", "1999-01-01"
PLANS = {OLD: f"PPA {OLD}", NEW: f"PPA {NEW}"}

_PART_CODE = (
    "concat({k}%4+3,'.',{k}%3+1,'.',{k}%5+1,'.',{k}%7+1,'.01.',lpad(cast({k}%1000 as string),3,'0'))"
)
_PART = _PART_CODE.replace("{k}", "l_partkey")
_SUPP = _PART_CODE.replace("{k}", "l_suppkey")

VIEWS = {
    "fx_cc_key": """
        select s_suppkey, s_name, n_name, r_name,
               concat(lpad(cast(n_regionkey as string),5,'0'),'.',
                      lpad(cast(n_nationkey as string),6,'0'),'.',
                      lpad(cast(s_suppkey%1000 as string),3,'0')) as codccusto
        from supplier join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey""",
    "fx_cost_center": """
        select distinct codccusto, s_name as campolivre from fx_cc_key
        union select left(codccusto,12), n_name from fx_cc_key
        union select left(codccusto,5), r_name from fx_cc_key""",
    "fx_account": f"""
        select c as codconta, right(c,3) as reduzido, concat('ACC ',c) as descricao,
               cast(case when length(c)=14 then 1 else 0 end as int) as analitica,
               cast(case when left(c,1) in ('3','5') then 1 else 0 end as int) as natureza
        from (with a as (select distinct {_PART_CODE.replace("{k}", "p_partkey")} as c from part)
              select c from a union select left(c,10) from a union select left(c,7) from a
              union select left(c,5) from a union select left(c,3) from a
              union select left(c,1) from a) p""",
    "fx_journal": f"""
        select l_orderkey as lctref, l_linenumber as idpartida, {_PART} as debito, {_SUPP} as credito,
               cast(l_extendedprice as decimal(18,2)) as valor, cast(l_shipdate as date) as data,
               case when l_linenumber<7 then cast(l_partkey%1000 as string) end as codhistp,
               cast(l_orderkey as string) as integrachave, concat('L',l_linenumber) as complemento
        from lineitem""",
    "fx_allocation": f"""
        select l_orderkey*10+l_linenumber as idrateio, l_orderkey as lctref, l_linenumber as idpartida,
               {_PART} as codconta, concat('G.',codccusto) as codgerencial,
               cast(case when l_tax<0.05 then l_extendedprice else 0 end as decimal(18,2)) as vlrdebito,
               cast(case when l_tax>0.02 then l_extendedprice else 0 end as decimal(18,2)) as vlrcredito
        from lineitem join fx_cc_key on l_suppkey=s_suppkey where l_returnflag='R'""",
    "fx_movement": """
        select o_orderkey as idmov, concat('2.1.',left(o_orderpriority,1)) as codtmv,
               o_custkey as codcfo, o_orderstatus as campolivre1, concat('u',o_custkey%10) as codusuario,
               cast(o_orderdate as date) as dataemissao,
               cast(o_totalprice as decimal(18,2)) as valorbrutoorig
        from orders""",
    "fx_counterparty": "select c_custkey as codcfo, c_name as nome from customer",
    "fx_instalment": """
        select (l_orderkey*10+l_linenumber)*100000+l_partkey as idlan, l_orderkey as idmov,
               concat('R',l_orderkey) as numerodocumento,
               case when l_linestatus='F' then ' BAIXADO '
                    when l_returnflag='A' and l_linenumber=1 then 'Cancelado'
                    else 'Em Aberto' end as descstatuslcto,
               cast(l_shipdate as date) as datavencimento, cast(l_linenumber as bigint) as idformapagto,
               case when l_linestatus='F' then 'Liquidado' else 'Registrado' end as descstatuscnab,
               case when l_returnflag='R' then 'Exportado' else 'Pendente' end as descstatusexportcontabilidade,
               concat('D',l_suppkey%10) as coddepartamento,
               case when l_suppkey%10=0 then '22.420-0' else 'CX1' end as codcxa,
               'A Receber' as descpagarreceber, lpad(cast(l_linenumber*10 as string),3,'0') as codtdo,
               cast(o_orderdate as date) as datacriacao,
               case when l_linestatus='F' then cast(l_shipdate as date)+cast(l_partkey%21-10 as int) end as databaixa,
               case when l_linestatus<>'F' and l_returnflag='A' and l_linenumber=1
                    then cast(l_shipdate as date) end as datacancelamento,
               case when l_partkey%13=0 then null when l_partkey%13=1 then 'DEV. adiantamento  viagem'
                    else concat('H',l_partkey%13) end as historico,
               cast(l_extendedprice as decimal(18,2)) as valororiginal,
               cast(case when l_linestatus='F' then cast(l_extendedprice as decimal(18,2))-5 else 0 end
                    as decimal(18,2)) as valorbaixado,
               cast(l_tax as decimal(18,2)) as valorjuros, cast(l_discount as decimal(18,2)) as valordesconto,
               cast(o_orderdate as date) as dataemissao, cast(l_shipdate as date)+5 as dataprevbaixa,
               o_custkey as codcfo, cast(l_quantity as decimal(18,2)) as valorop4bx,
               concat('AUT',l_partkey) as codautorizacaovenda, o_orderpriority as descricao_tipo_pagamento,
               cast(l_linenumber+100 as bigint) as codeventobaixa, concat('CC',l_suppkey) as codccusto,
               case when l_linenumber=7 then '2' else '1' end as pagrec
        from lineitem join orders on l_orderkey=o_orderkey""",
    "fx_fact": f"""
        select codccusto as nm_cc, {_PART} as nm_conta, cast(l_extendedprice as decimal(18,2)) as vl_valor,
               cast(l_shipdate as date) as nm_data,
               case when l_linenumber%3=0 then concat(lower(s_name),' ') else s_name end as nm_unidade,
               case when l_linenumber%4=0 then lower(r_name) else r_name end as nm_projeto,
               n_name as nm_acao, concat('N4 ',left({_PART},7)) as nm_descnvl4,
               case when l_partkey%4 in (0,2) then 'DESPESAS' else 'Receitas' end as nm_descnvl1,
               case when l_partkey%4=1 then 'REC A' when l_partkey%4=3 then 'REC B' else 'OUTROS' end as nm_descnvl3,
               concat('2.1.',l_linenumber) as cdg_codtmv, concat('C',l_orderkey%50) as cdg_contrato,
               case when l_suppkey%9<>0 then concat('F',l_suppkey%40) end as nm_fornecedor,
               concat('N6 ',left({_PART},9)) as nm_descnvl6, concat('N5 ',left({_PART},8)) as nm_descnvl5,
               concat('N2 ',left({_PART},3)) as nm_descnvl2
        from lineitem join fx_cc_key on l_suppkey=s_suppkey""",
    "fx_plan": f"""
        select concat('PPA ',year(l_shipdate)) as nm_ppa, s_name as nm_unidade, r_name as nm_iniciativa,
               n_name as nm_acao, case when l_suppkey%17<>0 then codccusto end as nm_cc,
               left({_PART},7) as cdg_natorcamentonvl4, concat('n4 ',left({_PART},7)) as nm_natorcamentonvl4,
               cast(year(l_shipdate) as int) as vl_ano, cast(month(l_shipdate) as int) as vl_mes,
               cast(cast(l_extendedprice as decimal(18,2))-10*l_linenumber as decimal(18,2)) as vl_ajustado
        from lineitem join fx_cc_key on l_suppkey=s_suppkey where l_returnflag='N'""",
    "fx_cube": """
        select nm_ppa, nm_iniciativa as entidade, nm_unidade, nm_iniciativa, nm_acao,
               cdg_natorcamentonvl4, nm_natorcamentonvl4, vl_ano, vl_mes, vl_ajustado,
               cast(vl_ajustado*2 as decimal(18,2)) as m_executado, cast(vl_ajustado-vl_mes as decimal(18,2)) as m_entidades,
               cast(vl_ajustado*3 as decimal(18,2)) as m_receita, cast(vl_ajustado+1 as decimal(18,2)) as m_cenario,
               cast(vl_ajustado*5 as decimal(18,2)) as m_contabil, cast(vl_ajustado-1 as decimal(18,2)) as m_foto_despesa,
               cast(vl_ajustado+vl_mes as decimal(18,2)) as m_foto_receita,
               vl_ano*100+vl_mes as fotografia, nm_unidade as nm_unidadeacao,
               nm_unidade as nm_unidadeiniciativa, nm_cc as cdg_rm, cdg_natorcamentonvl4 as nm_cdgnatureza,
               nm_natorcamentonvl4 as nm_descnvl4, vl_mes as nm_mes, vl_ano as nm_ano,
               cdg_natorcamentonvl4 as cdg_cdgnvl6, nm_natorcamentonvl4 as nm_descnvl6
        from fx_plan""",
    "fx_budget": """
        select nm_ppa,
               case when vl_mes=2 then upper(nm_unidade) when vl_mes=3 then concat(nm_unidade,'  ')
                    else nm_unidade end as nm_unidade,
               case when vl_mes=12 then concat('Cancelado ',nm_iniciativa) when vl_mes=11 then null
                    when nm_iniciativa='MIDDLE EAST' then 'ORIENTE MEDIO'
                    when vl_mes=4 then replace(nm_iniciativa,'A','Á')
                    when vl_mes=5 then lower(nm_iniciativa) when vl_mes=6 then replace(nm_iniciativa,'R','ř')
                    when vl_mes=7 then replace(replace(nm_iniciativa,'O','Ő'),'A','ă')
                    when vl_mes=8 then replace(nm_iniciativa,'E','E\u0301') else nm_iniciativa end as nm_iniciativa,
               case when vl_mes=9 then replace(replace(nm_acao,'L','ł'),'I','Į') else nm_acao end as nm_acao,
               cdg_natorcamentonvl4, nm_natorcamentonvl4, vl_ano, vl_mes, vl_ajustado
        from fx_plan""",
    "fx_year_map": f"""
        select distinct codccusto as cc, cast(year(l_shipdate) as string) as ano
        from lineitem join fx_cc_key on l_suppkey=s_suppkey where year(l_shipdate) in ({OLD},{NEW})""",
    "fx_allowlist": "select distinct codconta as conta from fx_allocation",
    "fx_national": """
        select codconta, concat('6',substring(codconta,2,6)) as nacional
        from fx_account where analitica=1 and left(codconta,1)='4'""",
    "fx_text_amount": """
        select o_orderkey as id,
               case when o_orderkey%11=0 then 'x' when o_orderkey%7=0 then null
                    else concat(cast(cast(floor(o_totalprice/1000) as int) as string),'.',
                                lpad(cast(cast(floor(o_totalprice) as int)%1000 as string),3,'0'),',50',o_orderkey%100)
               end as valor_str,
               concat(' ',case when o_orderkey%2=0 then 'a.' else 'b.' end,o_orderkey%9,') faixa ') as descricao
        from orders""",
    "fx_mixed_amount": """
        select o_orderkey as id,
               case when o_orderkey%7=0 then null when o_orderkey%11=0 then 'n/d'
                    when o_orderkey%5=0 then concat(cast(cast(floor(o_totalprice) as bigint) as string),',5')
                    else concat(cast(cast(floor(o_totalprice) as bigint) as string),'.5') end as vl_valor
        from orders""",
    "fx_typed": """
        select l_orderkey, l_linenumber, l_extendedprice as vl_preco,
               concat('0.0000000',l_linenumber,'5') as vl_empate,
               case when l_linenumber=1 then 'abc' when l_linenumber=2 then null
                    when l_linenumber=3 then '123456789012345678901'
                    else cast(l_orderkey as string) end as vl_texto,
               cast(l_discount as decimal(18,2)) as taxa, l_partkey as vl_inteiro
        from lineitem""",
    "fx_period": """
        select o_orderkey as id,
               case when o_orderkey%5=0 then 'x' when o_orderkey%7=0 then null
                    else concat(year(o_orderdate),'.7') end as vl_ano,
               cast(month(o_orderdate) as double)+0.5 as vl_mes
        from orders""",
    "fx_audit": """
        select o_orderpriority as nome_processo, o_orderdate as data_execucao, o_custkey as total_linhas,
               cast(o_orderkey%50 as int) as total_colunas, o_orderkey as total_nulos,
               case when o_orderkey%10=0 then '{quebrado' when o_orderkey%10=1 then null
                    else concat('{"kpis_gerais":{"total_linhas":',o_custkey,'}}') end as detalhes_json
        from orders""",
    # Details of every kind that a trail may hold: whole, without statistics, of other types, broken, missing.
    "fx_audit_full": """
        select o_orderpriority as nome_processo, o_orderdate as data_execucao, o_orderkey as total_linhas,
               cast(7 as int) as total_colunas, cast(0 as bigint) as total_nulos,
               case when o_orderkey%13=0 then '{quebrado' when o_orderkey%13=1 then null when o_orderkey%13=2 then '[1,2]'
                    when o_orderkey%13=3 then concat('{"kpis_gerais":{"total_linhas":"',o_custkey,'"},"estatisticas_numericas":7}')
                    when o_orderkey%13=4 then concat('{"kpis_gerais":{"total_linhas":',o_custkey,',"soma_total":',o_custkey,'.25}}')
                    else concat('{"kpis_gerais":{"total_linhas":',o_custkey,',"total_colunas":',o_orderkey%50,
                                '},"qualidade_dados":{"total_nulos":',o_orderkey,
                                '},"estatisticas_numericas":{"vl_ano":{"soma_total":',o_orderkey,'.5,"media":2,"maximo":',
                                o_custkey,',"minimo":null},"id":{"soma_total":1e3}}}') end as detalhes_json
        from orders""",
}


def _needed(text: str) -> list[str]:
    found: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\bfx_\w+", sql):
            if name not in found:
                visit(VIEWS[name])
                found.append(name)

    visit(text)
    return found


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """A statement with the views it mentions as common table expressions.

    ``extra`` names further expressions, in the order they build on each other.
    """
    more = extra or {}
    used = _needed(" ".join([*more.values(), sql]))
    parts = [f"{n} as ({VIEWS[n]})" for n in used] + [f"{n} as ({t})" for n, t in more.items()]
    return f"with {', '.join(parts)} {sql}" if parts else sql


_schemas: dict[str, StructType] = {}


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is looked up in the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view over the parquet tables of a folder."""
    text = with_views(f"select * from {name}")
    used: set[str] = set()

    def mark(match: re.Match) -> str:
        used.add(match[2])
        return f"{match[1]}{{{match[2]}}}"

    text = text.replace("{", "{{").replace("}", "}}")
    text = re.sub(rf"\b((?:from|join)\s+)({BASE})\b", mark, text)
    return spark.sql(text, **{t: base_table(spark, sf_dir, t) for t in used})
