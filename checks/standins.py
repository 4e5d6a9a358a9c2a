"""The given tables read as roster sources.

Every source is a projection of whole tables: customers are members, orders are
member months (the order year is the period), nations are contracts, line items
are relations of parts (read as members) to suppliers (read as providers), parts
are also plans and practices, events are external codes. Spellings, blanks and
NULLs are varied by value so that every rule of the roster meets its exceptions.
"""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll import RosterConfig, RosterSources

AS_OF = datetime(2001, 6, 1)

CONFIG = RosterConfig(
    contract_names=("Asia", "europe "),
    plan_prefix="Brand#2",
    data_sys_prefix="roster",
    id_prefix="XID",
    code_types=("CLICK", "view", "Purchase", "signup", "Error"),
    review_prefix="house",
)


TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the schema is known, so no job has to look it up."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as int) as patient_id",
        "concat(c_mktsegment, ' ', c_custkey) as last_name",
        "c_name as first_name",
        "nullif(c_mktsegment, 'BUILDING') as middle_name",
        """case c_mktsegment when 'AUTOMOBILE' then 'Male' when 'BUILDING' then 'FEMALE  '
             when 'FURNITURE' then 'u' when 'MACHINERY' then 'Unknown' end as gender""",
        "date_add(date'1940-01-01', cast(floor(c_acctbal) as int) + 1000) as birthdate",
        "lpad(cast(c_custkey as string), 9, '0') as ssn",
        "concat(c_name, ' Street') as address_line1",
        "nullif(c_mktsegment, 'FURNITURE') as address_line2",
        "c_mktsegment as city",
        "cast(c_nationkey as string) as state",
        "lpad(cast(c_nationkey as string), 5, '0') as postal_code",
        "lpad(cast(c_custkey as string), 10, '5') as phone_primary",
        """case when c_acctbal < 0 then 'Inactive' when c_mktsegment = 'MACHINERY'
             then 'ACTIVE  ' else 'active' end as patient_status""",
    )


def member_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey as int) as patient_id",
        "year(o_orderdate) as yearmo",
        "o_orderkey % 25 as contract_key",
        """case o_orderpriority
             when '1-URGENT' then concat('XID', o_custkey, o_orderstatus)
             when '2-HIGH' then concat('xid', o_custkey, '     ')
             when '5-LOW' then null
             when '3-MEDIUM' then concat(o_custkey, '-', lower(o_orderstatus))
             else concat(o_custkey, '-', o_orderstatus, if(o_orderkey % 3 = 0, '  ', '')) end
             as payer_patient_id""",
        "concat('S', o_custkey) as payer_subscriber",
        "nullif(o_orderpriority, '3-MEDIUM') as payer_relation",
        """case o_orderstatus when 'O' then 'ROSTER feed' when 'P' then 'roster-2'
             else 'other' end as data_sys""",
    )


def contract_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "cast(n_nationkey as bigint) as contract_key",
        "case when n_nationkey < 10 then r_name else concat(lower(r_name), ' ') end "
        "as contract_name",
        "n_name as lob",
        "case when n_nationkey = 12 then 0 else 1 end as is_contracted",
    )


def member_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_partkey as int) as patient_id",
        "l_suppkey as provider_key",
        """case l_returnflag when 'A' then 'PRIMARY' when 'N' then 'primary ' else 'Specialist'
             end as relationship_type""",
        "l_shipdate as relationship_end_date",
        "case l_linestatus when 'O' then 1 else 0 end as is_row_current",
    )


def provider_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other provider is there twice, under names that differ by case and blanks."""
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "*", "explode(if(s_suppkey % 2 = 0, array('', ' '), array(''))) as tail"
    )
    return suppliers.selectExpr(
        "s_suppkey as provider_key",
        "lpad(cast(s_suppkey div 2 as string), 10, '0') as npi",
        "if(tail = '', s_name, lower(s_name)) as first_name",
        "case when s_acctbal < 1000 then null else cast(s_nationkey as string) end as middle_name",
        "concat('Supplier ', s_suppkey, tail) as last_name",
        "case when s_nationkey = 3 then 0 else 1 end as is_row_current",
    )


def member_provider_remote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy that is not up to date: fewer rows are current."""
    return member_provider(spark, sf_dir).withColumn(
        "is_row_current", F.expr("if(patient_id % 7 = 0, 0, is_row_current)")
    )


def provider_dim_remote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provider_dim(spark, sf_dir).withColumn(
        "is_row_current", F.expr("if(provider_key % 11 = 0, 0, is_row_current)")
    )


def provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as contact_id",
        """case when s_nationkey = 4 then null
             when s_nationkey < 9 then concat(lpad(cast(s_suppkey div 2 as string), 10, '0'), ' ')
             else lpad(cast(s_suppkey div 2 as string), 10, '0') end as npi""",
        "s_name as first_name",
        "concat('Supplier ', s_suppkey) as last_name",
        "case when s_nationkey < 12 then 'MD' else 'DO' end as degree",
        "case when s_acctbal < 5000 then 'PCP' else 'SPEC' end as prov_type",
        """case when s_acctbal < 3000 then 'inactive' when s_nationkey < 12 then 'Active'
             else 'ACTIVE' end as status""",
        """case when s_acctbal < 3000
             then date_add(date'2000-01-01', cast(floor(s_acctbal) as int)) end as inactive_date""",
    )


def provider_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey div 20 as contact_id",
        "p_brand as med_plan",
        "case when p_size > 20 then date'2399-12-31' else date'1999-01-01' end "
        "as termination_date",
    )


def provider_practice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey div 20 as contact_id",
        "p_name as group_practice_name",
        """case p_type when 'PROMO' then '1' when 'SMALL' then 'YES  ' when 'MEDIUM' then 'yes'
             else 'No' end as primary_office""",
        "case when p_size <= 25 then 'ACTIVE' else 'Former' end as provider_in_practice",
        "case when p_size <= 8 then 'Y' end as hospital_employee",
    )


def id_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as int) as individual_id",
        "event_type as type_desc",
        """case event_type
             when 'click' then concat(event_id, if(value > 50, '   ', ''))
             when 'view' then concat('V', event_id)
             when 'purchase' then lpad(cast(event_id as string), 12, '7')
             when 'signup' then concat('xid', event_id)
             else case when value > 60 then '' else '000' end end as external_code""",
        "case when value >= 10 then 'ACTIVE ' else 'closed' end as status",
        "cast(date_trunc('DAY', ts) as timestamp_ntz) as last_upd_date",
    )


def id_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey as int) as patient_id",
        "case when s_nationkey = 7 then null else concat('C', s_suppkey) end "
        "as correct_external_code",
    )


def id_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'click' and value > 20")
        .selectExpr(
            "cast(user_id as int) as patient_id",
            "concat('0', event_id, if(value > 80, ' ', '')) as external_code",
        )
    )


READERS = {
    "member": member,
    "member_month": member_month,
    "contract_dim": contract_dim,
    "member_provider": member_provider,
    "provider_dim": provider_dim,
    "member_provider_remote": member_provider_remote,
    "provider_dim_remote": provider_dim_remote,
    "provider": provider,
    "provider_plan": provider_plan,
    "provider_practice": provider_practice,
    "id_crosswalk": id_crosswalk,
    "id_correction": id_correction,
    "id_blank": id_blank,
}


def sources(spark: SparkSession, sf_dir: str) -> RosterSources:
    return RosterSources({name: partial(read, spark, sf_dir) for name, read in READERS.items()})
