"""Flat clinical records as SQL over the order tables, in the common subset of Spark SQL and DuckDB.

``{orders}`` and the like stand for the base tables; ``TS`` for the zone-less timestamp type. Spark encodes these flat
rows as FHIR, CRM and HL7 documents and has to get them back; the oracle starts from the flat rows directly.
"""

from __future__ import annotations

import re

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def uuid_of(kind: str, key: str) -> str:
    """A UUID text that depends on kind and key alone."""
    digest = f"md5(concat('{kind}-', cast({key} as string)))"
    parts = ", '-', ".join(f"substr({digest}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"concat({parts})"


def padded(prefix: str, key: str, width: int) -> str:
    return f"concat('{prefix}', lpad(cast({key} as string), {width}, '0'))"


def days(n: str) -> str:
    return f"interval '1' day * ({n})"


def hours(n: str) -> str:
    return f"interval '1' hour * ({n})"


def minutes(n: str) -> str:
    return f"interval '1' minute * ({n})"


REVIEW_KEY = "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), cast(l_suppkey as string))"
COMPLETED_AT = f"l_shipdate - {days('l_linenumber % 6')} + {hours('l_partkey % 24')}"
ADMITTED_AT = f"cast('2024-01-01' as TS) + {days('o_orderkey % 30')} + {hours('o_orderkey % 24')} + {minutes('o_orderkey % 60')}"
DISCHARGED_AT = f"{ADMITTED_AT} + {hours('2 + o_orderkey % 167')} + {minutes('o_orderkey % 7')}"

FLAT: dict[str, str] = {
    "states": f"""
        select {uuid_of("state", "n_nationkey")} as id, lpad(cast(n_nationkey as string), 2, '0') as code,
          n_name as name, r_name as supervision_requirements, (n_nationkey % 5 + 1) * 7 as review_frequency_days,
          cast('2023-01-01' as TS) + {days("n_nationkey")} as created_at,
          cast('2023-02-01' as TS) + {days("n_nationkey")} as updated_at
        from {{nation}} join {{region}} on n_regionkey = r_regionkey""",
    "physicians": f"""
        select {uuid_of("physician", "s_suppkey")} as id, {padded("1", "s_suppkey", 9)} as npi,
          split_part(s_name, '#', 1) as first_name, split_part(s_name, '#', 2) as last_name,
          case s_suppkey % 4 when 0 then 'Cardiology' when 1 then 'Family Medicine' when 2 then 'Oncology' end as specialty,
          case when s_suppkey % 10 <> 9 then {uuid_of("state", "s_nationkey")} end as state_license_id,
          concat('s', cast(s_suppkey as string), '@clinic.example') as email,
          concat('555-', lpad(cast(s_suppkey as string), 4, '0')) as phone, s_suppkey % 7 <> 0 as is_active,
          cast('2022-03-01' as TS) + {days("s_suppkey % 365")} as created_at,
          cast('2023-03-01' as TS) + {hours("s_suppkey % 500")} as updated_at
        from {{supplier}}""",
    "providers": f"""
        select {uuid_of("provider", "c_custkey")} as id, {padded("2", "c_custkey", 9)} as npi,
          split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
          case when c_custkey % 2 = 0 then 'NP' else 'PA' end as provider_type,
          case when c_custkey % 20 <> 19 then {uuid_of("physician", "c_custkey % (select count(*) from {supplier})")}
            end as supervising_physician_id,
          {uuid_of("state", "c_nationkey")} as state_id,
          concat('c', cast(c_custkey as string), '@clinic.example') as email,
          case when c_custkey % 5 <> 0 then concat('556-', lpad(cast(c_custkey as string), 6, '0')) end as phone,
          cast(cast('2020-01-01' as TS) + {days("c_custkey % 1000")} as date) as hire_date,
          c_custkey % 11 <> 0 as is_active,
          cast('2020-01-01' as TS) + {days("c_custkey % 1000")} as created_at,
          cast('2023-01-01' as TS) + {hours("c_custkey % 1000")} as updated_at
        from {{customer}}""",
    "cases": f"""
        select {uuid_of("case", "o_orderkey")} as id, {uuid_of("provider", "o_custkey")} as provider_id,
          {padded("MRN", "o_custkey", 7)} as patient_mrn,
          case when o_totalprice > 300000 then 'complex' else 'routine' end as case_type,
          case o_orderstatus when 'F' then 'closed' when 'O' then 'open' else 'pending_review' end as status,
          case o_orderpriority when '1-URGENT' then 'urgent' when '2-HIGH' then 'high' when '5-LOW' then 'low'
            else 'normal' end as priority,
          o_orderdate as created_at,
          case when o_orderstatus = 'F' then o_orderdate + {days("30")} end as closed_at,
          o_orderdate + {days("1")} as updated_at
        from {{orders}}""",
    "case_reviews": f"""
        select {uuid_of("review", REVIEW_KEY)} as id, {uuid_of("case", "l_orderkey")} as case_id,
          {uuid_of("physician", "l_suppkey")} as physician_id,
          case when l_returnflag = 'A' then cast({COMPLETED_AT} as date) else cast(l_shipdate as date) end as review_date,
          case l_returnflag when 'A' then 'completed' when 'R' then 'overdue' else 'pending' end as review_status,
          case when l_linenumber % 3 = 0 then concat('line ', cast(l_linenumber as string)) end as notes,
          cast(l_shipdate as date) as due_date,
          case when l_returnflag = 'A' then {COMPLETED_AT} end as completed_at,
          l_shipdate - {days("30")} as created_at, l_shipdate as updated_at
        from {{lineitem}}""",
    "patients": f"""
        select {padded("pat-", "c_custkey", 7)} as patient_id, {padded("MRN", "c_custkey", 7)} as mrn,
          split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
          cast(cast(cast('1950-01-01' as TS) + {days("c_custkey % 20000")} as date) as string) as date_of_birth,
          case when c_custkey % 2 = 0 then 'female' else 'male' end as gender,
          concat('557-', lpad(cast(c_custkey as string), 6, '0')) as phone,
          case when c_custkey % 6 <> 0 then concat('p', cast(c_custkey as string), '@mail.example') end as email,
          concat(cast(c_custkey as string), ' Main St') as address_line,
          concat('City ', cast(c_nationkey as string)) as city,
          lpad(cast(c_nationkey as string), 2, '0') as state,
          lpad(cast(c_custkey % 99999 as string), 5, '0') as postal_code, lower(c_mktsegment) as insurance_type
        from {{customer}}""",
    "appointments": f"""
        select concat('appt-', cast(event_id as string)) as appointment_id,
          case when event_type in ('purchase', 'signup') then 'fulfilled' when event_type = 'view' then 'booked'
            when event_type = 'error' then 'noshow' else 'cancelled' end as appointment_status,
          case when event_id % 13 <> 0 then concat('Visit ', event_type) end as appointment_type,
          ts as scheduled_start, ts + {minutes("15 * (event_id % 4 + 1)")} as scheduled_end,
          cast(15 * (event_id % 4 + 1) as int) as duration_minutes, ts - {days("event_id % 10")} as created_at,
          {padded("pat-", "user_id", 7)} as patient_id,
          case when event_id % 97 <> 0 then {padded("2", "user_id % 50", 9)} end as provider_npi
        from {{events}}""",
    "encounters": f"""
        select concat('enc-', cast(event_id as string)) as encounter_id,
          case when event_id % 9 = 0 then 'in-progress' else 'finished' end as encounter_status,
          case event_id % 3 when 0 then 'AMB' when 1 then 'EMER' else 'IMP' end as encounter_class,
          concat('Type ', event_type) as encounter_type, {padded("pat-", "user_id", 7)} as patient_id,
          {padded("2", "user_id % 50", 9)} as provider_npi, ts as encounter_start,
          ts + {minutes("event_id % 90")} as encounter_end,
          concat('complaint ', cast(event_id % 17 as string)) as chief_complaint,
          case when event_id % 11 <> 0 then concat('Diagnosis ', cast(event_id % 7 as string)) end
            as primary_diagnosis_desc,
          case when event_id % 11 <> 0 then concat('D', cast(event_id % 7 as string)) end as primary_diagnosis_code,
          cast(event_id % 90 as int) as length_minutes
        from {{events}} where event_type in ('purchase', 'signup')""",
    "admissions": f"""
        select concat('ADT', cast(o_orderkey as string)) as message_id, {padded("MRN", "o_custkey", 7)} as patient_mrn,
          'Customer' as patient_last_name, lpad(cast(o_custkey as string), 9, '0') as patient_first_name,
          '19800101' as patient_dob, case when o_custkey % 2 = 0 then 'F' else 'M' end as patient_gender,
          {padded("2", "o_custkey % 50", 9)} as attending_provider_npi,
          case o_orderkey % 3 when 0 then 'I' when 1 then 'E' else 'O' end as patient_class,
          {ADMITTED_AT} as admit_datetime, concat('VN', cast(o_orderkey as string)) as visit_number,
          'HOSPITAL' as sending_facility, {ADMITTED_AT} as message_datetime
        from {{orders}}""",
    "discharges": f"""
        select concat('DSC', cast(o_orderkey as string)) as message_id, {padded("MRN", "o_custkey", 7)} as patient_mrn,
          'Customer' as patient_last_name, lpad(cast(o_custkey as string), 9, '0') as patient_first_name,
          {padded("2", "o_custkey % 50", 9)} as attending_provider_npi,
          case o_orderkey % 3 when 0 then 'I' when 1 then 'E' else 'O' end as patient_class,
          {ADMITTED_AT} as admit_datetime, {DISCHARGED_AT} as discharge_datetime,
          concat('VN', cast(o_orderkey as string)) as visit_number, 'HOSPITAL' as sending_facility,
          {DISCHARGED_AT} as message_datetime
        from {{orders}} where o_orderstatus = 'F'""",
    "contacts": f"""
        select cast(c_custkey as string) as contact_id, split_part(c_name, '#', 1) as first_name,
          concat('O"', split_part(c_name, '#', 2), ', Jr') as last_name,
          concat('k', cast(c_custkey as string), '@crm.example') as email,
          concat('558-', cast(c_custkey as string)) as phone, concat('Company ', cast(c_nationkey as string)) as company,
          'Practice Manager' as job_title, lower(c_mktsegment) as lifecycle_stage,
          case when c_custkey % 4 = 0 then 'NEW' else 'OPEN' end as lead_status,
          cast('2023-06-01' as TS) + {hours("c_custkey % 5000")} as created_at,
          cast('2023-06-01' as TS) + {hours("c_custkey % 5000")} + {days("c_custkey % 400")} as modified_at
        from {{customer}}""",
    "deals": """
        select cast(o_orderkey as string) as id, concat('Deal ', cast(o_orderkey as string)) as dealname,
          cast(cast(floor(o_totalprice) as bigint) as string) as amount, lower(o_orderstatus) as dealstage,
          case when o_orderkey % 3 <> 0 then cast(o_custkey as string) end as contact_id
        from {orders}""",
}

# Results of one ORU message for each order line: none to three, by line number.
LAB_VALUE = "cast(l_quantity as bigint) + {i} * 7"
LAB_LOW, LAB_HIGH = 10, 30
LABS = 3


def lab_value(i: int) -> str:
    return LAB_VALUE.format(i=i)


FLAT["lab_results"] = " union all ".join(
    f"""
        select concat('ORU', {REVIEW_KEY}) as message_id, {padded("MRN", "l_orderkey", 7)} as patient_mrn,
          'Line' as patient_last_name, cast(l_linenumber as string) as patient_first_name,
          {padded("2", "l_suppkey", 9)} as ordering_provider_npi, concat('ORD', cast(l_orderkey as string)) as order_number,
          'T{i}' as test_code, 'Test {i}' as test_name, cast({lab_value(i)} as string) as result_value,
          'mg/dL' as result_units, '{LAB_LOW}-{LAB_HIGH}' as reference_range,
          case when {lab_value(i)} >= 40 then 'HH' when {lab_value(i)} > 30 then 'H' when {lab_value(i)} <= 6 then 'LL'
            when {lab_value(i)} < 10 then 'L' else 'N' end as abnormal_flag,
          l_shipdate as observation_datetime, 'LAB' as sending_facility, l_shipdate as message_datetime
        from {{lineitem}} where l_linenumber % 4 > {i}"""
    for i in range(LABS)
)


def flat_sql(name: str, timestamp: str) -> str:
    return re.sub(r"\bTS\b", timestamp, FLAT[name])


def duck_ctes(*names: str) -> str:
    """``with`` clause that offers the flat records under their names."""
    bases = {table: table for table in BASE_TABLES}
    parts = [f"{name} as ({flat_sql(name, 'timestamp').format(**bases)})" for name in names]
    return "with " + ",\n".join(parts)
