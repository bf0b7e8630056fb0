"""Schemas of the tables that pass between steps, as DDL."""

MAIL = "message_id STRING, thread_id STRING, subject STRING, `from` STRING, `to` ARRAY<STRING>, cc STRING, reply_to STRING, date STRING, body_text STRING, attachments ARRAY<STRUCT<filename: STRING, data: STRING, mime_type: STRING, size: BIGINT>>"
BODY = "message_id STRING, body_text STRING"
MAIL_TYPE = "message_id STRING, mail_type STRING"
SKILLS = "ARRAY<STRUCT<skill: STRING, match: BOOLEAN, note: STRING>>"
REQUIREMENTS = f"message_id STRING, required_skills {SKILLS}, optional_skills {SKILLS}"
SHEET = "message_id STRING, skillsheet STRING, source STRING, success BOOLEAN, urls STRING, tried_urls ARRAY<STRING>, failure_reason STRING"
#: One row per demand or supply mail, all attributes; null: not known.
DEMAND = "message_id STRING, unit_price BIGINT, age_max INT, remote_type STRING, foreign_ok BOOLEAN, freelance_ok BOOLEAN, workload_min INT, workload_max INT, flow_level INT, skills ARRAY<STRING>, primary_skills ARRAY<STRING>, phases ARRAY<STRING>, location STRING, contract_type STRING"
SUPPLY = "message_id STRING, unit_price BIGINT, age INT, remote_type STRING, nationality STRING, employment STRING, workload_min INT, workload_max INT, vendor_flow INT, skills ARRAY<STRING>, phases ARRAY<STRING>, location STRING"
HISTORY = "demand_from STRING, demand_subject STRING, supply_from STRING, supply_subject STRING"
MAIL_TYPES = ("project", "resource", "ambiguous", "unknown")
