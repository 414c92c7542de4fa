"""People-shaped inputs derived from the orders and customers.

Each recipe is one SQL text for both engines; only the few spellings in
``DIALECT`` differ. Records are built as text, so both engines read the same
bytes and a missing key is not the same as a null.
"""

from __future__ import annotations

import datetime as dt
import re

AS_OF = dt.date(2001, 8, 1)
RUN_TS = dt.datetime(2001, 8, 1, 6, tzinfo=dt.timezone.utc)
BATCH_ID = "00000000-0000-4000-8000-000000000001"

DIALECT = {
    "spark": {
        "LEFT_DAY": "date_add(cast(o_orderdate as date), cast((o_orderkey*37)%900 as int))",
        "TS": "cast('{}' as timestamp_ntz)",
        "APPLIED": "date_format(o_orderdate + make_dt_interval(0,0,0,o_orderkey*977%86400),"
        " \"yyyy-MM-dd'T'HH:mm:ss\")",
        "CHANGED": "date_format(o_orderdate + make_dt_interval(0,0,0,"
        "o_orderkey*977%86400 + o_orderkey*7919%5184000 - 259200), \"yyyy-MM-dd'T'HH:mm:ss\")",
        "JOIN_PAGE": "array_join(transform(array_sort(collect_list(struct(k, payload))), x -> x.payload), ',')",
        "DIV": "k div 100",
        "EPOCH_DAY": "datediff(hire_date, date '1970-01-01')",
        "EPOCH": "cast(unix_seconds(cast(o_orderdate as timestamp)) + o_orderkey*977%86400 as bigint)",
        "OFFSET": """regexp_replace(payload, '("applied_at":"[^"]*)"', '$1{}"')""",
    },
    "duckdb": {
        "LEFT_DAY": "cast(o_orderdate as date) + cast((o_orderkey*37)%900 as integer)",
        "TS": "cast('{}' as timestamp)",
        "APPLIED": "strftime(o_orderdate + to_seconds(o_orderkey*977%86400), '%Y-%m-%dT%H:%M:%S')",
        "CHANGED": "strftime(o_orderdate + to_seconds("
        "o_orderkey*977%86400 + o_orderkey*7919%5184000 - 259200), '%Y-%m-%dT%H:%M:%S')",
        "JOIN_PAGE": "string_agg(payload, ',' order by k)",
        "DIV": "k // 100",
        "EPOCH_DAY": "(hire_date - date '1970-01-01')",
        "EPOCH": "cast(epoch(o_orderdate) + o_orderkey*977%86400 as bigint)",
        "OFFSET": """regexp_replace(payload, '("applied_at":"[^"]*)"', '\\1{}"')""",
    },
}

EMP = """
select o_orderkey k, 'E'||o_orderkey employee_id, o_orderpriority department,
  case cast(o_orderkey%9 as int) when 0 then 'IC1' when 1 then 'IC2' when 2 then 'IC3'
    when 3 then 'IC4' when 4 then 'IC5' when 5 then 'M1' when 6 then 'M2' when 7 then 'M3'
    else 'M4' end as level,
  case when o_orderkey%10<8 then 'full_time' when o_orderkey%10=8 then 'part_time'
    else 'contractor' end employment_type,
  cast(o_orderdate as date) hire_date,
  case when o_orderkey%20<3 then <<LEFT_DAY>> end termination_date
from orders
"""

NATIVE_WORKERS = """
select k, hire_date, employment_type, '{"Worker_ID":"'||employee_id||'","Legal_First_Name":" First'||(k%97)
 ||'","Legal_Last_Name":"Last'||(k%89)||'","Work_Email":"e'||k||'@example.com","Cost_Center":"'
 ||department||'","Job_Title":"Title '||(k%7)||'","Hire_Date":"'||hire_date||'"'
 || case when termination_date is not null then ',"Termination_Date":"'||termination_date||'"'
         when k%2=0 then ',"Termination_Date":null' else '' end
 || ',"Worker_Type":"'||employment_type||'","Management_Level":"'||level||'","Location":"Site '||(k%6)||'"'
 || case when k%10=0 then ',"Manager_ID":null' else ',"Manager_ID":"E'||(k%50)||'"' end
 || case when k%13=0 then ',"Base_Pay":"'||(80000+k%240000)||'.2512345600"'
         else ',"Base_Pay":'||(80000+k%240000)||'.25' end
 || case when k%4=0 then ',"Performance_Rating":null' else ',"Performance_Rating":"meets"' end
 || case when k%1000=7 then ',"ssn":"000-00-'||k||'"' else '' end || '}' payload
from emp
"""

# Workers with every kind of broken rule.
DIRTY_WORKERS = """
select k, case
   when k%701=3 then replace(payload, '"Hire_Date":"'||hire_date||'"', '"Hire_Date":""')
   when k%709=5 then replace(payload, '"Work_Email":"e'||k||'@example.com"', '"Work_Email":null')
   when k%719=7 then replace(payload, '"Location":"Site '||(k%6)||'"', '"Location":7')
   when k%727=9 then replace(payload, '"Base_Pay":'||(80000+k%240000)||'.25', '"Base_Pay":"abc"')
   when k%733=11 then replace(payload, ',"Worker_Type":"'||employment_type||'"', '')
   when k%739=13 then replace(replace(payload, '"Hire_Date":"'||hire_date||'"', '"Hire_Date":"2001-02-30"'),
                              '"Work_Email":"e'||k||'@example.com"', '"Work_Email":["x"]')
   else payload end payload
from native_workers
"""

# Hire dates as numbers: seconds, milliseconds, as text, off midnight, beyond any date.
EPOCH_WORKERS = """
select k, replace(payload, '"Hire_Date":"'||hire_date||'"', '"Hire_Date":'||case cast(k%11 as int)
   when 0 then cast(<<EPOCH_DAY>>*86400 as varchar(30)) when 1 then <<EPOCH_DAY>>*86400||'.0'
   when 2 then <<EPOCH_DAY>>*cast(86400 as bigint)*1000||'' when 3 then '"'||<<EPOCH_DAY>>*86400||'"'
   when 4 then <<EPOCH_DAY>>*86400+1||'' when 5 then '"'||<<EPOCH_DAY>>*cast(86400 as bigint)*1000||'"'
   when 6 then 'true' when 7 then '999999999999999999' when 8 then '-12000000000'
   when 9 then '"'||<<EPOCH_DAY>>*86400||'.0"' else '"'||hire_date||'"' end) payload
from native_workers
"""

# Times as numbers: seconds, milliseconds, with a fraction, as text.
EPOCH_APPLICATIONS = """
select o_orderkey k, '{"id":"A'||o_orderkey||'","candidate_id":"C","job_id":"J","job_title":"T","department":"D"'
 ||',"status":"hired","applied_at":'||case cast(o_orderkey%6 as int) when 0 then <<EPOCH>>||'' when 1 then <<EPOCH>>||'250'
   when 2 then <<EPOCH>>||'.5' when 3 then '"'||<<EPOCH>>||'"' when 4 then '"'||<<EPOCH>>||'.25"' else 'false' end
 ||',"last_activity_at":"2001-01-01T00:00:00"}' payload
from orders
"""

WORKER_PAGES = """
select '{"data":['||<<JOIN_PAGE>>||'],"_links":{"next":"/api/v1/workers?page='||(<<DIV>> + 2)||'"}}' page, min(k) first_k
from native_workers group by <<DIV>>
union all
select '{"_links":{}}', 0 from region
"""

# The newest hires have a member that no earlier record has.
LATE_WORKERS = """
select k, case when k > 2000 then substr(payload, 1, length(payload) - 1)||',"Badge":'||k||'}' else payload end payload
from native_workers
"""

LATE_WORKER_PAGES = """
select '{"data":['||<<JOIN_PAGE>>||'],"_links":{}}' page, min(k) first_k from late_workers group by <<DIV>>
"""

OFFSET_APPLICATIONS = """
select k, case cast(k%4 as int) when 0 then <<OFFSET:+02:00>> when 1 then <<OFFSET:Z>>
  when 2 then <<OFFSET:.250>> else payload end payload
from native_applications
"""

APPLICATION_PAGES = """
select '{"data":['||<<JOIN_PAGE>>||'],"_links":{}}' page, min(k) first_k
from native_applications group by <<DIV>>
"""

WRAPPED_EMPLOYEES = """
select k, case when k%250=3 then '{"id":"rec'||k||'"}' else
 '{"id":"rec'||k||'","fields":{"source_id":"'||employee_id||'","first_name":"First'||(k%97)||'","last_name":"Last'
 ||(k%89)||'","email":"e'||k||'@example.com","department":"'||department||'","job_title":"Title '||(k%7)
 ||'","hire_date":"'||hire_date||'"'
 || case when termination_date is not null then ',"termination_date":"'||termination_date||'"' else '' end
 || case when k%3=0 then '' when k%100=1 then ',"employment_type":null'
         else ',"employment_type":"'||employment_type||'"' end
 || ',"level":"'||level||'","location":"Site '||(k%6)||'"}}' end page_row
from emp
"""

# Every customer stands for an employee whom a second source knows as well.
RAW_EMPLOYEES = """
select case when k%50=1 then 'greenhouse' else 'workday' end source, source_id, payload,
  <<TS:2001-07-02 06:00:00>> ingested_at, k from raw_base
union all
select 'airtable', source_id, replace(payload,'"Title ','"Lead '),
  case when k%250=0 then null when k%50=0 then <<TS:2001-07-03 06:00:00>> else <<TS:2001-07-01 06:00:00>> end, k
from raw_base join customer on k = c_custkey * 10
"""

# k = 5 has no id; some departments are null, some levels and types unknown.
RAW_BASE = """
select k, employee_id source_id, '{"source_id":'||case when k=5 then 'null' else '"'||employee_id||'"' end
 ||',"first_name":'||case when k%333=0 then 'null' else '"First'||(k%97)||'"' end||',"last_name":"Last'||(k%89)
 ||'","email":"e'||k||'@example.com","department":'||case when k%613=0 then 'null' else '"'||department||'"' end
 ||',"job_title":"Title '||(k%7)||'","hire_date":"'||hire_date
 ||'","termination_date":'||coalesce('"'||termination_date||'"', case when k%3=0 then '""' else 'null' end)
 ||',"manager_id":null,"employment_type":"'||case when k%1111=4 then 'intern' else employment_type end
 ||'","level":"'||case when k%777=3 then 'X1' else level end||'","location":"Site '||(k%6)
 ||'","salary":'||case when k%5=0 then '""' else '"'||(80000+k%240000)||'.25"' end
 ||',"performance_rating":'||case when k%4=0 then '""' else '"meets"' end||'}' payload from emp
"""

NATIVE_APPLICATIONS = """
select o_orderkey k, '{"id":"A'||o_orderkey||'","candidate_id":"C'||o_custkey||'","job_id":"JOB-'||(1000+o_orderkey%100)
 ||'","job_title":" Title '||(o_orderkey%7)||' ","department":"'||o_orderpriority||'"'
 || case (o_orderkey*7+o_custkey)%9 when 0 then ',"status":"active"' when 1 then ',"status":"submitted"'
    when 2 then ',"status":"phone_screen"' when 3 then ',"status":"interviewing"' when 4 then ',"status":"offer_extended"'
    when 5 then ',"status":"hired"' when 6 then ',"status":"rejected"' when 7 then ',"status":null' else '' end
 || ',"applied_at":"'||<<APPLIED>>||'"'
 || case when o_orderkey%11=0 then '' when o_orderkey%401=0 then ',"last_activity_at":null'
    else ',"last_activity_at":"'||<<CHANGED>>||'"' end
 || case when o_orderkey%5=0 then ',"recruiter_id":null' else ',"recruiter_id":"R'||(o_orderkey%13)||'"' end || '}' payload
from orders
"""

RAW_APPLICATIONS = """
select case when o_orderkey%25=0 then 'airtable' when o_orderkey%50=1 then 'workday' else 'greenhouse' end source,
 'A'||o_orderkey source_id, o_orderkey k,
 '{"source_id":"A'||o_orderkey||'","candidate_id":"C'||o_custkey||'","job_id":"JOB-'||(1000+o_orderkey%100)
 ||'","job_title":"Title '||(o_orderkey%7)||'","department":'
 || case when o_orderkey%613=0 then 'null' else '"'||o_orderpriority||'"' end
 ||',"stage":"'|| case (o_orderkey*7+o_custkey)%9 when 2 then 'phone_screen' when 3 then 'interview'
    when 4 then 'offer' when 5 then 'hired' when 6 then 'rejected' else 'applied' end
 ||'","applied_at":"'||<<APPLIED>>||'","stage_changed_at":'
 || case when o_orderkey%401=0 then 'null' else '"'||<<CHANGED>>||'"' end
 || ',"recruiter_id":' || case when o_orderkey%5=0 then 'null' else '"R'||(o_orderkey%13)||'"' end || '}' payload
from orders
"""

RECIPES = {
    "emp": (EMP, ()),
    "native_workers": (NATIVE_WORKERS, ("emp",)),
    "dirty_workers": (DIRTY_WORKERS, ("emp", "native_workers")),
    "epoch_workers": (EPOCH_WORKERS, ("emp", "native_workers")),
    "epoch_applications": (EPOCH_APPLICATIONS, ()),
    "worker_pages": (WORKER_PAGES, ("emp", "native_workers")),
    "late_workers": (LATE_WORKERS, ("emp", "native_workers")),
    "late_worker_pages": (LATE_WORKER_PAGES, ("emp", "native_workers", "late_workers")),
    "wrapped_employees": (WRAPPED_EMPLOYEES, ("emp",)),
    "raw_base": (RAW_BASE, ("emp",)),
    "raw_employees": (RAW_EMPLOYEES, ("emp", "raw_base")),
    "native_applications": (NATIVE_APPLICATIONS, ()),
    "offset_applications": (OFFSET_APPLICATIONS, ("native_applications",)),
    "application_pages": (APPLICATION_PAGES, ("native_applications",)),
    "raw_applications": (RAW_APPLICATIONS, ()),
}


def _spell(text: str, dialect: str) -> str:
    def word(match: re.Match) -> str:
        name, value = match.groups()
        return DIALECT[dialect][name].format(value)

    return re.sub(r"<<(\w+):?(.*?)>>", word, text)


def ctes(name: str, dialect: str) -> str:
    """``emp as (...), ...`` for a recipe and everything it is made from."""
    _, needs = RECIPES[name]
    parts = [*needs, name]
    return ",\n".join(f"{p} as ({_spell(RECIPES[p][0], dialect)})" for p in parts)
