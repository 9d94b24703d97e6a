"""DuckDB SQL for the queries, written against the given tables."""

from __future__ import annotations

from checks.fixtures import VIEWS, view_sql

# Views every statement may use, in order of dependency.
_BASE = "".join(f"{name} as ({view_sql(name, 'epoch_ms(o_orderdate)')}),\n" for name in VIEWS)

_DERIVED = r"""
forms as (
  select *,
    case when regexp_full_match(trim(duration_raw), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)')
         then cast(trunc(cast(duration_raw as double)) as bigint) end as days,
    case when requestor_urn like 'urn:li:corpuser:_%' then substr(requestor_urn, 17) end as username
  from requests),
wf as (select * from forms where request_type = 'WORKFLOW_FORM_REQUEST'),
approved as (
  select * from wf
  where status = 'COMPLETED' and result = 'ACCEPTED' and created_ms >= 988848000000),
pending as (select * from wf where status = 'PENDING'),
default_roles as (
  select username, trim(value) as default_role from user_properties
  where property = 'DEFAULT_ROLE' and trim(value) <> ''),
resolved as (
  select f.*, r.default_role,
    coalesce(nullif(f.snowflake_role, ''), r.default_role) as resolved_role,
    case when f.snowflake_role <> '' then 'form'
         when r.default_role is not null then 'default_role' end as role_origin,
    coalesce(nullif(f.requestor_email, ''),
             case when contains(f.username, '@') then f.username end) as resolved_email,
    case when days <> 0 and abs(days) <= 2921362 then 996624000000 + days * 86400000 end as expires_ms
  from forms f
  left join default_roles r
    on r.username = f.username and (f.snowflake_role is null or f.snowflake_role = '')),
candidates as (select * from resolved where urn in (select urn from approved)),
decided as (
  select *, case
    when urn in (select latest_action_request_urn from grants) then 'skip_provisioned'
    when urn in (select action_request_urn from provisioning_errors) then 'skip_failed'
    when resolved_role is null or snowflake_database is null then 'skip_missing_fields'
    when abs(days) > 2921362 then 'skip_duration_out_of_range'
    else 'provision' end as decision
  from candidates),
ready as (
  select *, coalesce(snowflake_schema, '') as schema_key,
    row_number() over (partition by resolved_role, snowflake_database, coalesce(snowflake_schema, '')
                       order by seq) as turn
  from candidates
  where resolved_role is not null and snowflake_database is not null
    and coalesce(abs(days), 0) <= 2921362
    and urn not in (select action_request_urn from provisioning_errors)),
held as (
  select r.urn from ready r join grants g
    on g.snowflake_role = r.resolved_role and g.snowflake_database = r.snowflake_database
   and g.snowflake_schema = r.schema_key and g.latest_action_request_urn = r.urn
  where r.turn = 1 and g.revoked_at_ms is null),
decided_latest as (
  select *, case
    when urn in (select urn from held) then 'skip_provisioned'
    when urn in (select action_request_urn from provisioning_errors) then
      case when urn in (select latest_action_request_urn from grants g where revoked_at_ms is null
                        and not exists (select 1 from ready r
                          where r.resolved_role = g.snowflake_role
                            and r.snowflake_database = g.snowflake_database
                            and r.schema_key = g.snowflake_schema and r.seq < candidates.seq))
           then 'skip_provisioned' else 'skip_failed' end
    when resolved_role is null or snowflake_database is null then 'skip_missing_fields'
    when abs(days) > 2921362 then 'skip_duration_out_of_range'
    else 'provision' end as decision
  from candidates),
provisioned as (select *, coalesce(snowflake_schema, '') as schema_key
                from decided where decision = 'provision'),
outcomes as (
  select *, case when seq % 31 <> 0 then 'granted' when seq % 62 = 0 then 'permanent'
                 else 'transient' end as outcome
  from provisioned),
granted as (select * from outcomes where outcome = 'granted'),
active_expired as (
  select * from grants where expires_at_ms <= 996624000000 and revoked_at_ms is null),
breaches as (
  select *, (996624000000 - created_ms) / 3600000.0 as hours,
    case when created_ms <= 996624000000 - 72 * 3600000 then 'escalation'
         when created_ms <= 996624000000 - 24 * 3600000 then 'warning' end as sla_class
  from pending where created_ms <> 0),
due as (
  select * from breaches b where sla_class is not null
    and not exists (select 1 from sla_notifications s
                    where s.action_request_urn = b.urn and s.notification_type = b.sla_class)),
routed as (
  select * from change_events
  where event_type = 'MetadataChangeLogEvent_v1' and entity_type = 'actionRequest'
    and aspect_name = 'actionRequestStatus' and entity_urn <> ''),
changed as (select entity_urn as urn, count(*) as events from routed group by entity_urn),
live as (
  select r.*, c.events, case
    when request_type <> 'WORKFLOW_FORM_REQUEST' then 'ignore_type'
    when status = 'COMPLETED' and result = 'ACCEPTED' then
      case when r.urn in (select latest_action_request_urn from grants) then 'skip_provisioned'
           when resolved_role is null or snowflake_database is null then 'skip_missing_fields'
           when abs(days) > 2921362 then 'skip_duration_out_of_range'
           else 'provision' end
    when status = 'COMPLETED' and result = 'REJECTED' then 'deny'
    else 'ignore_status' end as decision
  from resolved r join changed c on c.urn = r.urn)
"""

_GRANT_STATEMENTS = """
select urn, 1 as stmt_no, 'GRANT USAGE ON DATABASE ' || snowflake_database || ' TO ROLE ' || resolved_role as statement
from provisioned
union all
select urn, 2, 'GRANT USAGE ON SCHEMA ' || snowflake_database || '.' || schema_key || ' TO ROLE ' || resolved_role
from provisioned where schema_key <> ''
union all
{tables}
union all
select urn, 2, 'GRANT USAGE ON ALL SCHEMAS IN DATABASE ' || snowflake_database || ' TO ROLE ' || resolved_role
from provisioned where schema_key = ''
union all
select urn, 3, 'GRANT USAGE ON FUTURE SCHEMAS IN DATABASE ' || snowflake_database || ' TO ROLE ' || resolved_role
from provisioned where schema_key = ''
union all
select urn, case when schema_key = '' then 4 else {last} end,
  'GRANT USAGE ON WAREHOUSE QUERY_WH TO ROLE ' || resolved_role
from provisioned
"""

_EXECUTED_TABLES = """
select urn, 3, 'GRANT SELECT ON ALL TABLES IN SCHEMA ' || snowflake_database || '.' || schema_key || ' TO ROLE ' || resolved_role
from provisioned where schema_key <> ''
union all
select urn, 4, 'GRANT SELECT ON FUTURE TABLES IN SCHEMA ' || snowflake_database || '.' || schema_key || ' TO ROLE ' || resolved_role
from provisioned where schema_key <> ''
"""

_REPORTED_TABLES = """
select urn, 3, 'GRANT SELECT ON ALL/FUTURE TABLES IN SCHEMA ' || snowflake_database || '.' || schema_key || ' TO ROLE ' || resolved_role
from provisioned where schema_key <> ''
"""

_DB_REVOKE = "'REVOKE USAGE ON DATABASE ' || snowflake_database || ' FROM ROLE ' || snowflake_role"
_SCHEMA_NAME = "snowflake_database || '.' || snowflake_schema || ' FROM ROLE ' || snowflake_role"

_STATE_AFTER = """
winners as (
  select * from (
    select *, row_number() over (
      partition by resolved_role, snowflake_database, schema_key order by seq desc) as rn
    from granted) where rn = 1),
merged as (
  select coalesce(w.resolved_role, g.snowflake_role) as snowflake_role,
    coalesce(w.snowflake_database, g.snowflake_database) as snowflake_database,
    coalesce(w.schema_key, g.snowflake_schema) as snowflake_schema,
    coalesce(w.urn, g.latest_action_request_urn) as urn,
    case when w.urn is not null then w.resolved_email else g.requestor_email end as requestor_email,
    case when w.urn is not null then 996624000000 else g.granted_at_ms end as granted_ms,
    case when w.urn is not null then w.expires_ms else g.expires_at_ms end as expires_ms,
    case when w.urn is not null then null else g.revoked_at_ms end as revoked_ms
  from grants g full join winners w
    on g.snowflake_role = w.resolved_role and g.snowflake_database = w.snowflake_database
   and g.snowflake_schema = w.schema_key)
"""

_AFTER_EXPIRY = """
select snowflake_role, snowflake_database, snowflake_schema, urn, requestor_email,
  granted_ms, expires_ms,
  case when expires_ms <= 996624000000 and revoked_ms is null
        and (snowflake_schema = '' or cast(split_part(urn, ':', 4) as bigint) % 31 <> 0)
       then 996624000000 else revoked_ms end as revoked_ms
from merged
"""

_SWITCHES = """
, ended as (
  select count(*) as n from merged where expires_ms <= 996624000000 and revoked_ms is null
    and (snowflake_schema = '' or cast(split_part(urn, ':', 4) as bigint) % 31 <> 0)),
counted as (
  select (select count(*) from granted) as g, (select n from ended) as r,
    (select count(*) from due) as s)
select 'dry_run' as switch, 0 as granted, 0 as revoked, 0 as mails, 0 as sla
union all select 'dry_then_live', g, r, r, s from counted
union all select 'expiry_off', g, 0, 0, s from counted
union all select 'mail_off', g, r, 0, s from counted
"""

_MAIL = """'{kind}' as type, urn, coalesce(nullif(requestor_email, ''), '') as recipients,
  '' as copies, '{subject}' as subject, coalesce(requestor_email, '') <> '' as deliverable"""

_FORM_PLACES = """
  coalesce(resource, '—') as p_resource, coalesce(snowflake_database, '—') as p_database,
  coalesce(nullif(snowflake_schema, ''), '(all schemas)') as p_schema"""

_JOURNAL_OF_GRANTED = """
select resolved_role as snowflake_role, snowflake_database, schema_key as snowflake_schema,
  'grant' as op, urn, resolved_email as requestor_email, 996624000000 as granted_ms, expires_ms,
  cast(null as bigint) as revoked_ms, false as dry_run
from granted
"""

_LIVE_ACTIONS = """
select urn, decision as action from live where decision in ('provision', 'deny')
"""

# Both stream queries end with the decisions of one batch.
_SELECTS: dict[str, str] = {
    "q01_approved_scan": "select seq, urn, created_ms, requestor_urn from approved",
    "q01_json_catchup": """
select line as seq, urn, decision
from (select seq as place, row_number() over (order by seq) - 1 as line from requests)
join decided on seq = place where place % 40 not in (1, 4)
union all select count(*), null, 'malformed_json' from requests where seq % 40 = 1 having count(*) > 0
union all select count(*), null, 'missing:status' from requests where seq % 40 = 4 having count(*) > 0""",
    "q02_pending_scan": """
select urn, created_ms, requestor_urn, requestor_email, resource,
  case when owner_urn is null then '' else owner_urn || ',urn:li:corpuser:deputy' end as assigned_users,
  coalesce(group_urn, '') as assigned_groups
from pending""",
    "q03_point_lookup": """
select urn, request_type, status, result from requests
where urn in (select entity_urn from change_events where entity_urn <> '')""",
    "q04_schema_check": """
select reason, count(*) as n,
  cast(sum(case when reason = 'ok' then created_ms end) as bigint) as created_sum,
  sum(case when reason = 'ok' then 6 + (seq % 21 = 4)::int
        + (seq % 5 = 2 and snowflake_role is not null)::int end)::bigint as fields
from (select *, case seq % 40
    when 1 then 'malformed_json' when 2 then 'not_an_object' when 3 then 'bad_type:status'
    when 4 then 'missing:status' when 5 then 'missing:created.time'
    when 6 then 'bad_type:created.time' when 8 then 'bad_type:fields' when 11 then 'bad_type:fields'
    when 9 then 'bad_type:assignedUsers' else 'ok' end as reason
  from requests)
group by reason""",
    "q11_value_union": """
select urn, 'snowflake_role' as field, snowflake_role as value from requests where snowflake_role is not null
union all select urn, 'snowflake_database', snowflake_database from requests where snowflake_database is not null
union all select urn, 'snowflake_schema', snowflake_schema from requests where snowflake_schema is not null
union all select urn, 'access_duration_days', duration_raw from requests where duration_raw is not null
union all select urn, 'requestor_email', requestor_email from requests where requestor_email is not null
union all select urn, 'justification', justification from requests where justification is not null
union all select urn, 'ticket', 'T-1' from requests where seq % 21 = 4""",
    "q13_form_map": """
select urn, snowflake_role, snowflake_database, snowflake_schema, duration_raw, requestor_email,
  justification from requests""",
    "q15_duration": """
select urn, duration_raw, days,
  case when duration_raw is null or days is not null then null
       when duration_raw = 'inf' then 'duration_not_finite'
       else 'duration_unparsable' end as problem
from forms""",
    "q16_flatten": """
select seq, urn, request_type, status, result, note, resource, requestor_urn, created_ms,
  cast(null as bigint) as due_date_ms, days as access_duration_days from forms""",
    "q18_identity": """
select urn, username, split_part(username, '@', 1) as local_part,
  case when contains(username, '@') then username end as urn_email,
  case when requestor_email <> '' then requestor_email
       when contains(username, '@') then username end as resolved_email
from forms""",
    "q21_expiry_ts": """
select urn, expires_ms + 789 as expires_ms,
  strftime(make_timestamp(expires_ms * 1000), '%Y-%m-%d %H:%M:%S') as stored,
  expires_ms as stored_ms
from resolved""",
    "q28_event_filter": "select event_id, entity_urn from routed",
    "q29_provisionable": """
select urn, case
  when resolved_role is null and snowflake_database is null then 'missing_role_and_database'
  when resolved_role is null then 'missing_role'
  when snowflake_database is null then 'missing_database' else 'ready' end as reason
from candidates""",
    "q30_expired": """
select snowflake_role, snowflake_database, nullif(snowflake_schema, '') as snowflake_schema,
  latest_action_request_urn as urn, requestor_email, granted_at_ms as granted_ms,
  expires_at_ms as expires_ms
from active_expired""",
    "q34_not_provisioned": """
select seq, urn from approved a where not exists (
  select 1 from grants g where g.latest_action_request_urn = a.urn and g.revoked_at_ms is null)""",
    "q35_not_failed": """
select seq, urn from approved a where not exists (
  select 1 from provisioning_errors e where e.action_request_urn = a.urn)""",
    "q36_sla_dedup": "select urn, sla_class from due",
    "q37_default_roles": "select username, default_role from default_roles",
    "q38_role": "select urn, resolved_role, role_origin, resolved_email from resolved",
    "q39_event_request": "select urn, decision, events from live",
    "q39_event_unmatched": """
select urn, events from changed where urn not in (select urn from requests)""",
    "q40_conformance": """
select urn, 'snowflake_database' as field_id, 'missing_required' as rule from requests where snowflake_database is null
union all select urn, 'snowflake_role', 'missing_required' from requests where snowflake_role is null
union all select urn, 'requestor_email', 'missing_required' from requests where requestor_email is null
union all select urn, 'justification', 'missing_required' from requests where justification is null
union all select urn, 'snowflake_schema', 'too_many_values' from requests
  where snowflake_schema is not null and seq % 14 = 5
union all select urn, 'access_duration_days', 'wrong_type' from requests
  where duration_raw is not null
    and not (seq % 2 = 0 and regexp_full_match(duration_raw, '-?[0-9.]+'))
union all select urn, 'ticket', 'unknown_field' from requests where seq % 21 = 4""",
    "q40_product_conformance": """
select 'urn:li:actionRequest:part' || p_partkey as urn, 'use_case' as field_id,
  'missing_required' as rule from part where p_size = 7 or p_type is null
union all select 'urn:li:actionRequest:part' || p_partkey, 'priority', 'missing_required'
from part where p_size > 30
union all select 'urn:li:actionRequest:part' || p_partkey, 'priority', 'not_allowed'
from part where p_size > 20 and p_size <= 30
union all select 'urn:li:actionRequest:part' || p_partkey, 'requestor_email', 'wrong_type'
from part where p_retailprice is not null""",
    "q41_catchup": """
select seq, urn, decision,
  case when decision in ('skip_provisioned', 'skip_failed') then nullif(snowflake_role, '')
       else resolved_role end as resolved_role
from decided""",
    "q41_catchup_latest": "select seq, urn, resolved_role, decision from decided_latest",
    "q43_last_writer": """
select resolved_role as snowflake_role, snowflake_database,
  coalesce(snowflake_schema, '') as snowflake_schema, max(seq) as seq
from decided_latest where decision = 'provision'
group by resolved_role, snowflake_database, coalesce(snowflake_schema, '')""",
    "q44_sla_class": """
select urn, coalesce(sla_class, 'in_time') as sla_class, hours as pending_hours,
  cast(round_even(hours, 0) as bigint) as printed_hours
from breaches""",
    "q45_outcomes": """
select urn, outcome, outcome <> 'granted' as partial,
  case when outcome <> 'granted' then 2 end as failed_stmt,
  case outcome when 'permanent' then 2003 when 'transient' then 604 end as errno,
  case outcome when 'permanent' then 'object does not exist'
               when 'transient' then 'statement timed out' end as message
from outcomes""",
    "q48_later_outcomes": """
select urn, case outcome when 'transient' then 'open' else outcome end as state,
  case when outcome = 'transient' or seq % 2 = 1 then 'run-3' else 'run-2' end as run_id,
  case when outcome = 'transient' then 0 else 1 end as mails
from outcomes""",
    "q52_sla_state": """
select action_request_urn, notification_type, 996537600000 as sent_ms from sla_notifications
union all select urn, sla_class, 996624000000 from due""",
    "q53_error_state": """
select action_request_urn, snowflake_error_code, error_message, 996537600000 as failed_ms
from provisioning_errors
union all select urn, '2003', 'object does not exist', 996624000000
from outcomes where outcome = 'permanent'""",
    "q56_metrics": """
select decision, count(*) as requests,
  sum(case when decision <> 'provision' then 0 when coalesce(snowflake_schema, '') = '' then 4
           else 5 end)::bigint as statements
from decided group by decision""",
    "q57_quarantine": """
select urn, case when duration_raw = 'inf' then 'duration_not_finite' else 'duration_unparsable' end as reason,
  duration_raw as detail
from decided where duration_raw is not null and days is null
union all
select urn, 'duration_out_of_range', duration_raw from decided where abs(days) > 2921362
union all
select urn, case when resolved_role is null and snowflake_database is null then 'missing_role_and_database'
                 when resolved_role is null then 'missing_role' else 'missing_database' end,
  requestor_urn
from decided where decision = 'skip_missing_fields'
union all
select urn, 'unsafe_identifier', resolved_role || '.' || snowflake_database || '.' || snowflake_schema
from decided
where snowflake_schema = 'BAD NAME' and snowflake_database is not null and
  case when decision in ('skip_provisioned', 'skip_failed') then snowflake_role <> ''
       else resolved_role is not null end""",
    "q63_grant_plan": _GRANT_STATEMENTS.format(tables=_EXECUTED_TABLES, last=5),
    "q63r_grant_reported": _GRANT_STATEMENTS.format(tables=_REPORTED_TABLES, last=4),
    "q65_revoke_plan": f"""
select latest_action_request_urn as urn, 1 as stmt_no, 'REVOKE SELECT ON ALL TABLES IN SCHEMA ' || {_SCHEMA_NAME} as statement
from active_expired where snowflake_schema <> ''
union all select latest_action_request_urn, 2, 'REVOKE SELECT ON FUTURE TABLES IN SCHEMA ' || {_SCHEMA_NAME}
from active_expired where snowflake_schema <> ''
union all select latest_action_request_urn, 3, 'REVOKE USAGE ON SCHEMA ' || {_SCHEMA_NAME}
from active_expired where snowflake_schema <> ''
union all select latest_action_request_urn, case when snowflake_schema = '' then 1 else 4 end, {_DB_REVOKE}
from active_expired""",
    "q65r_revoke_reported": f"""
select latest_action_request_urn as urn, 1 as stmt_no, 'REVOKE SELECT ON ALL/FUTURE TABLES IN SCHEMA ' || {_SCHEMA_NAME} as statement
from active_expired where snowflake_schema <> ''
union all select latest_action_request_urn, 2, 'REVOKE USAGE ON SCHEMA ' || {_SCHEMA_NAME}
from active_expired where snowflake_schema <> ''
union all select latest_action_request_urn, case when snowflake_schema = '' then 1 else 3 end, {_DB_REVOKE}
from active_expired""",
    "q65s_shared_revokes": f"""
select latest_action_request_urn as urn, stmt_no, statement from (
  select *, row_number() over (
    partition by snowflake_role, snowflake_database, snowflake_schema order by place) as stmt_no
  from (
    select e.*, 1 as place, 'REVOKE SELECT ON ALL TABLES IN SCHEMA ' || {_SCHEMA_NAME} as statement
    from active_expired e where snowflake_schema <> ''
    union all select *, 2, 'REVOKE SELECT ON FUTURE TABLES IN SCHEMA ' || {_SCHEMA_NAME}
    from active_expired where snowflake_schema <> ''
    union all select *, 3, 'REVOKE USAGE ON SCHEMA ' || {_SCHEMA_NAME}
    from active_expired e where snowflake_schema <> '' and not exists (
      select 1 from grants g where g.snowflake_role = e.snowflake_role
        and g.snowflake_database = e.snowflake_database and g.snowflake_schema = ''
        and revoked_at_ms is null and (expires_at_ms is null or expires_at_ms > 996624000000))
    union all select *, 4, {_DB_REVOKE}
    from active_expired e where not exists (
      select 1 from grants g where g.snowflake_role = e.snowflake_role
        and g.snowflake_database = e.snowflake_database
        and revoked_at_ms is null and (expires_at_ms is null or expires_at_ms > 996624000000))))
union all select latest_action_request_urn, 0, 'revoked' from active_expired""",
    "q66_role_grant": """
select urn, 'GRANT ROLE ' || snowflake_role || ' TO ROLE ' || r.default_role as statement
from forms f join default_roles r on r.username = f.username where f.snowflake_role <> ''""",
    "q67_approval_mail": f"""
select {_MAIL.format(kind="approval", subject="✅ Your data catalog access request has been approved")},
  {_FORM_PLACES}, coalesce(nullif(snowflake_role, ''), '—') as p_role,
  case when days <> 0 then days || ' days' else 'Indefinite' end as p_duration,
  coalesce(note, '') as p_note,
  (select string_agg(statement, chr(10) order by stmt_no) from (
    {_GRANT_STATEMENTS.format(tables=_REPORTED_TABLES, last=4)}) s where s.urn = granted.urn) as p_statements
from granted""",
    "q68_denial_mail": f"""
select {_MAIL.format(kind="denial", subject="❌ Your data catalog access request has been denied")},
  coalesce(resource, '—') as p_resource, coalesce(nullif(note, ''), 'No reason provided.') as p_note
from live where decision = 'deny' and seq % 5 <> 0""",
    "q68_denial_mail_each": "select urn, events as mails from live where decision = 'deny'",
    "q69_sla_mail": """
select sla_class as type, urn, coalesce(requestor_email, '') as recipients,
  case sla_class when 'escalation' then 'lead@example.com,chief@example.com' else '' end as copies,
  case sla_class
    when 'escalation' then '🚨 Escalation: access request pending ' || h || 'h — immediate action required'
    else '⚠️ Action required: access request pending for ' || h || 'h' end as subject,
  coalesce(requestor_email, '') <> '' as deliverable,
  coalesce(resource, urn) as p_resource, h as p_hours,
  case sla_class when 'escalation' then coalesce(nullif(requestor_email, ''), '—') end as p_assignees,
  urn as p_link
from (select *, cast(cast(round_even(hours, 0) as bigint) as varchar) as h from due)""",
    "q71_failure_mail": f"""
select {_MAIL.format(kind="failure", subject="⚠️ data catalog access request could not be provisioned")},
  {_FORM_PLACES}, 'object does not exist' as p_error, urn as p_request
from outcomes where outcome = 'permanent'""",
    "q72_revocation_mail": """
select 'revocation' as type, latest_action_request_urn as urn,
  coalesce(requestor_email, '') as recipients, '' as copies,
  '🔒 Your warehouse access has expired and been revoked' as subject,
  requestor_email is not null as deliverable, snowflake_database as p_database,
  case when snowflake_schema = '' then '(all schemas)' else snowflake_schema end as p_schema,
  snowflake_role as p_role, latest_action_request_urn as p_request
from active_expired
where snowflake_schema = '' or cast(split_part(latest_action_request_urn, ':', 4) as bigint) % 31 <> 0""",
    "q73_approval_pass": _JOURNAL_OF_GRANTED,
    "q74_expiry_pass": """
select snowflake_role, snowflake_database, snowflake_schema, 'revoke' as op,
  latest_action_request_urn as urn, requestor_email, granted_at_ms as granted_ms,
  expires_at_ms as expires_ms, 996624000000 as revoked_ms, false as dry_run
from active_expired
where snowflake_schema = '' or cast(split_part(latest_action_request_urn, ':', 4) as bigint) % 31 <> 0""",
    "q75_sla_pass": """
select sla_class as type, urn, coalesce(requestor_email, '') <> '' as deliverable,
  996624000000 as sent_ms from due""",
    "q28_event_envelopes": """
select problem, event_id, entity_urn from (
  select event_id, case when event_id % 10 = 3 then null else entity_urn end as entity_urn,
    case when event_id % 10 = 3 then 'malformed_envelope' end as problem,
    event_type = 'MetadataChangeLogEvent_v1' and entity_type = 'actionRequest'
      and aspect_name = 'actionRequestStatus' and entity_urn <> '' as is_routed
  from change_events)
where problem is not null or is_routed""",
    "q77_stream_live": _LIVE_ACTIONS,
    "q79_stream_redelivery": _LIVE_ACTIONS,
    "q81_event_fates": """
select concat('run-', run) as run_id, count(*) as received,
  count(*) filter (fate = 'fresh') as fresh, count(*) filter (fate = 'redelivered') as redelivered,
  count(*) filter (fate = 'late') as late, 0::bigint as untracked, 0::bigint as lost
from (
  select run, case
    when us < max(us) over (order by run range between unbounded preceding and 1 preceding)
              // 1000 * 1000 - 48 * 3600000000
      and us < 1706500000000000 - 48 * 3600000000 then 'late'
    when row_number() over (partition by event_id, us order by run) > 1 then 'redelivered'
    else 'fresh' end as fate
  from (
    select 0 as run, event_id, epoch_us(event_ts) as us from routed where event_id % 4 <> 0
    union all select 1, event_id, epoch_us(event_ts) from routed
    union all select 1, event_id, epoch_us(event_ts) from routed where event_id % 3 = 0
    union all select 2, event_id, epoch_us(event_ts) from routed))
group by run""",
    "q65p_residual_privileges": """
select snowflake_role, snowflake_database, snowflake_schema,
  unnest(case when snowflake_schema = '' then [
    'GRANT USAGE ON ALL SCHEMAS IN DATABASE ' || snowflake_database || ' TO ROLE ' || snowflake_role,
    'GRANT USAGE ON FUTURE SCHEMAS IN DATABASE ' || snowflake_database || ' TO ROLE ' || snowflake_role,
    'GRANT USAGE ON WAREHOUSE QUERY_WH TO ROLE ' || snowflake_role]
  else ['GRANT USAGE ON WAREHOUSE QUERY_WH TO ROLE ' || snowflake_role] end) as statement
from grants where revoked_at_ms is not null""",
}


def all_oracles() -> dict[str, str]:
    head = f"with {_BASE}{_DERIVED.strip()}"
    found = {name: f"{head}\n{select.strip()}" for name, select in _SELECTS.items()}
    after = f"{head},\n{_STATE_AFTER.strip()}\n{_AFTER_EXPIRY.strip()}"
    found["q49_state_after"] = after
    found["q76_full_pass"] = after
    found["q76_compacted_pass"] = after
    found["q30_due_calendar"] = found["q30_expired"]
    found["q33_switches"] = f"{head},\n{_STATE_AFTER.strip()}\n{_SWITCHES.strip()}"
    return dict(sorted(found.items()))
