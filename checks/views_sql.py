"""The views of ``views.py`` as DuckDB SQL, and text helpers for the oracles."""

from __future__ import annotations

import re

VIEWS = {
    "incidents": """
        SELECT 'INC' || lpad(o_orderkey::VARCHAR, greatest(length(o_orderkey::VARCHAR), 7)::INTEGER, '0') AS number,
               md5('INC' || lpad(o_orderkey::VARCHAR, greatest(length(o_orderkey::VARCHAR), 7)::INTEGER, '0')) AS sys_id,
               CASE WHEN o_orderkey % 10 IN (3, 6, 9) THEN md5('INC' || lpad((o_orderkey - o_orderkey % 10)::VARCHAR,
                    greatest(length((o_orderkey - o_orderkey % 10)::VARCHAR), 7)::INTEGER, '0')) END AS parent,
               CASE o_orderkey % 7 WHEN 0 THEN 'WiFi connectivity issue' WHEN 1 THEN 'VPN connection failing'
                    WHEN 2 THEN 'Printer spits out blank pages' WHEN 3 THEN 'Slow performance on host'
                    WHEN 4 THEN 'DNS answers late for two sites' WHEN 5 THEN 'Badge reader offline at the gate' END AS short_description,
               'Reported by ' || c_name || ' near Room ' || (o_orderkey % 90)::VARCHAR
                    || ', affecting ' || (o_orderkey % 300)::VARCHAR || ' users' AS description,
               CASE o_orderpriority WHEN '1-URGENT' THEN '1 - Critical' WHEN '2-HIGH' THEN '2 - High'
                    WHEN '3-MEDIUM' THEN '3 - Moderate' WHEN '4-NOT SPECIFIED' THEN '4 - Low'
                    WHEN '5-LOW' THEN '5 - Planning' END AS priority,
               CASE o_orderstatus WHEN 'O' THEN 'New' WHEN 'P' THEN 'In Progress' WHEN 'F' THEN 'Resolved' END AS state,
               o_orderdate::TIMESTAMP AS opened_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate::TIMESTAMP + to_hours(qty) END AS resolved_at,
               coalesce(lines, 0)::INTEGER AS reassignment_count,
               lpad(c_nationkey::VARCHAR, 5, '0') || ' - ' || n_name || ' - ' || r_name || ' / ' || c_mktsegment AS location,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Server' WHEN 'BUILDING' THEN 'Access Point'
                    WHEN 'FURNITURE' THEN 'Network Printer' WHEN 'HOUSEHOLD' THEN 'WiFi' ELSE 'Firewall' END AS ci_type,
               (CASE WHEN o_orderkey % 3 = 0 THEN 'Network ' ELSE 'Desk ' END) || n_name AS assignment_group,
               c_name AS caller_id,
               CASE WHEN o_orderkey % 2 = 0 THEN '{"display_value":"' || c_name || '"}' ELSE c_name END AS assigned_to,
               c_mktsegment AS category,
               'CI-' || c_nationkey::VARCHAR AS cmdb_ci,
               CASE o_orderpriority WHEN '1-URGENT' THEN '1 - Critical' WHEN '2-HIGH' THEN '2 - High'
                    WHEN '3-MEDIUM' THEN '3 - Moderate' WHEN '4-NOT SPECIFIED' THEN '4 - Low'
                    WHEN '5-LOW' THEN '5 - Planning' END AS impact,
               CASE o_orderpriority WHEN '1-URGENT' THEN '1 - Critical' WHEN '2-HIGH' THEN '2 - High'
                    WHEN '3-MEDIUM' THEN '3 - Moderate' WHEN '4-NOT SPECIFIED' THEN '4 - Low'
                    WHEN '5-LOW' THEN '5 - Planning' END AS urgency,
               CASE o_orderkey % 9 WHEN 0 THEN 'Misconfigured VLAN corrected.'
                    WHEN 1 THEN 'Hardware failure on the uplink, part replaced.' WHEN 2 THEN 'Software bug patched.'
                    WHEN 3 THEN 'Network outage at the provider.' WHEN 4 THEN 'User error, password reset.'
                    WHEN 5 THEN 'Disk full, log files rotated.' WHEN 6 THEN 'Unauthorized access blocked.'
                    WHEN 7 THEN '' END AS close_notes
        FROM orders
        LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey
        LEFT JOIN (SELECT l_orderkey, sum(l_quantity)::INTEGER AS qty, count(*) AS lines
                   FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "enriched": """
        SELECT *, coalesce(hours > CASE WHEN high THEN 24 ELSE 72 END, FALSE) AS breach
        FROM (SELECT *,
                coalesce(state IN ('New', 'In Progress', 'Awaiting User Info'), FALSE) AS active,
                coalesce(contains(priority, '1 - Critical') OR contains(priority, '2 - High'), FALSE) AS high,
                CASE WHEN regexp_matches(lower(short_description), 'wifi|wireless|access point') THEN 'WiFi/Wireless'
                     WHEN regexp_matches(lower(short_description), 'vpn|remote') THEN 'VPN/Remote Access'
                     WHEN regexp_matches(lower(short_description), 'printer|print') THEN 'Network Printing'
                     WHEN regexp_matches(lower(short_description), 'server|performance') THEN 'Server/Performance'
                     WHEN regexp_matches(lower(short_description), 'dns|resolution') THEN 'DNS/Resolution'
                     ELSE 'Other Network' END AS pattern,
                (epoch_us(resolved_at) - epoch_us(opened_at))::DOUBLE / 1000000 / 3600 AS hours,
                CASE WHEN contains(lower(ci_type), 'server')
                          THEN 50 + ('0x' || substr(md5(number), 1, 8))::BIGINT % 150
                     WHEN regexp_matches(lower(ci_type), 'access point|wifi')
                          THEN 20 + ('0x' || substr(md5(number), 1, 8))::BIGINT % 80
                     WHEN contains(lower(ci_type), 'printer')
                          THEN 5 + ('0x' || substr(md5(number), 1, 8))::BIGINT % 25
                     ELSE 1 + ('0x' || substr(md5(number), 1, 8))::BIGINT % 49 END::INTEGER AS users,
                week(opened_at)::INTEGER AS week
              FROM incidents)""",
    "journal": """
        SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR || '-' || l_partkey::VARCHAR
                    || '-' || l_suppkey::VARCHAR AS entry_id,
               md5('INC' || lpad(l_orderkey::VARCHAR, greatest(length(l_orderkey::VARCHAR), 7)::INTEGER, '0')) AS element_id,
               'incident' AS name,
               CASE l_linenumber % 3 WHEN 0 THEN 'work_notes' WHEN 1 THEN 'comments' ELSE 'assignment_group' END AS element,
               o_orderdate::TIMESTAMP + to_hours(l_linenumber) AS sys_created_on,
               s_name AS author,
               CASE l_partkey % 4 WHEN 0 THEN 'Checked the logs.'
                    WHEN 1 THEN 'Found it. The root cause was a failed route update. Rolled back.'
                    WHEN 2 THEN 'Still down for the whole site' ELSE 'Waiting for the vendor.' END AS value
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey""",
    "problem_links": """
        SELECT DISTINCT 'PRB' || lpad(p_partkey::VARCHAR, greatest(length(p_partkey::VARCHAR), 6)::INTEGER, '0')
                    || '-' || (l_orderkey // 10000)::VARCHAR AS related_number,
               p_name AS short_description, '2 - High' AS priority, 'Open' AS state,
               '1995-01-01 00:00:00' AS opened_at, NULL::VARCHAR AS ended_at,
               md5('INC' || lpad(l_orderkey::VARCHAR, greatest(length(l_orderkey::VARCHAR), 7)::INTEGER, '0')) AS sys_id
        FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_linenumber = 1""",
    "change_links": """
        SELECT DISTINCT 'CHG' || lpad(s_suppkey::VARCHAR, greatest(length(s_suppkey::VARCHAR), 6)::INTEGER, '0')
                    || '-' || (l_orderkey // 10000)::VARCHAR AS related_number,
               s_name AS short_description, '3 - Moderate' AS priority, 'Closed' AS state,
               '1995-01-02 00:00:00' AS opened_at, '1995-01-03 12:00:00' AS ended_at,
               md5('INC' || lpad(l_orderkey::VARCHAR, greatest(length(l_orderkey::VARCHAR), 7)::INTEGER, '0')) AS sys_id
        FROM supplier JOIN lineitem ON l_suppkey = s_suppkey WHERE l_linenumber = 2""",
    "child_links": """
        SELECT number AS related_number, short_description, priority, state,
               strftime(opened_at, '%Y-%m-%d %H:%M:%S') AS opened_at,
               strftime(resolved_at, '%Y-%m-%d %H:%M:%S') AS ended_at, parent AS sys_id
        FROM incidents WHERE parent IS NOT NULL""",
    "related": """
        SELECT 'incident' AS kind, * FROM child_links
        UNION ALL SELECT 'problem', * FROM problem_links
        UNION ALL SELECT 'change', * FROM change_links""",
    "related_ranked": """
        SELECT i.number, i.sys_id, kind, related_number,
               substr(coalesce(related.short_description, ''), 1, 60) AS short_description,
               (row_number() OVER (PARTITION BY i.sys_id, kind ORDER BY related_number))::INTEGER AS position
        FROM related JOIN incidents i ON i.sys_id = related.sys_id""",
    "notes": """
        SELECT i.number, i.sys_id, element, strftime(sys_created_on, '%Y-%m-%d %H:%M:%S') AS timestamp,
               entry_id, author, value
        FROM journal JOIN incidents i ON i.sys_id = element_id""",
    "events_all": """
        SELECT number, sys_id, opened_at AS ts, 0 AS seq, '' AS entry_id, 'Incident Created' AS event_type,
               caller_id AS actor, 'Incident ' || number || ' created' AS description,
               coalesce(short_description, '') AS details
        FROM incidents WHERE opened_at IS NOT NULL
        UNION ALL
        SELECT number, sys_id, sys_created_on, 1, entry_id, 'Journal Entry', element, substr(value, 1, 200), name
        FROM journal JOIN incidents ON sys_id = element_id
        UNION ALL
        SELECT number, sys_id, resolved_at, 2, '', 'Incident Resolved',
               coalesce(CASE WHEN json_valid(assigned_to) THEN json_extract_string(assigned_to, '$.display_value') END,
                        assigned_to), 'Incident resolved', coalesce(close_notes, '')
        FROM incidents WHERE resolved_at IS NOT NULL""",
    "events_ranked": """
        SELECT *, (row_number() OVER (PARTITION BY sys_id ORDER BY ts, seq, entry_id))::INTEGER AS position,
               count(*) OVER (PARTITION BY sys_id) AS total
        FROM events_all""",
    "sentences": r"""
        SELECT sys_id, nullif(trim(regexp_extract(text, '[^.]*root cause[^.]*\.', 0), chr(32) || chr(9) || chr(10) || chr(13)), '') AS sentence
        FROM (SELECT element_id AS sys_id,
                     lower(string_agg(value, ' ' ORDER BY element = 'comments', sys_created_on, entry_id)) AS text
              FROM journal WHERE element IN ('work_notes', 'comments') GROUP BY element_id)""",
    "first_problems": """
        SELECT sys_id, arg_min(short_description, related_number) AS first_problem FROM problem_links GROUP BY sys_id""",
    "note_causes": """
        SELECT number, CASE
            WHEN regexp_matches(lower(close_notes), 'misconfigured|configuration error|config issue|wrong setting')
                THEN 'Configuration: ' || substr(close_notes, 1, 200)
            WHEN regexp_matches(lower(close_notes), 'hardware failure|device failed|equipment failure|hardware issue')
                THEN 'Hardware: ' || substr(close_notes, 1, 200)
            WHEN regexp_matches(lower(close_notes), 'software bug|application error|code issue|software failure')
                THEN 'Software: ' || substr(close_notes, 1, 200)
            WHEN regexp_matches(lower(close_notes), 'network outage|connectivity issue|routing problem|network failure')
                THEN 'Network: ' || substr(close_notes, 1, 200)
            WHEN regexp_matches(lower(close_notes), 'user error|mistake|accidental|human error')
                THEN 'Human Error: ' || substr(close_notes, 1, 200)
            WHEN regexp_matches(lower(close_notes), 'capacity exceeded|resource exhaustion|out of memory|disk full')
                THEN 'Capacity: ' || substr(close_notes, 1, 200)
            WHEN regexp_matches(lower(close_notes), 'security breach|unauthorized access|malware|attack')
                THEN 'Security: ' || substr(close_notes, 1, 200) END AS cause
        FROM incidents""",
    "root_causes": """
        SELECT i.number, i.sys_id, coalesce(cause, sentence, 'Related Problem: ' || nullif(first_problem, ''),
               'Based on incident description: ' || substr(coalesce(nullif(description, ''), nullif(short_description, '')), 1, 200),
               'Root cause not clearly identified from available data. Manual review recommended.') AS root_cause
        FROM incidents i JOIN note_causes c ON c.number = i.number
        LEFT JOIN sentences s ON s.sys_id = i.sys_id LEFT JOIN first_problems p ON p.sys_id = i.sys_id""",
    "factors": """
        SELECT number, sys_id, concat_ws(chr(10),
            CASE WHEN reassignment_count > 2 THEN 'Incident was reassigned ' || reassignment_count::VARCHAR
                 || ' times, indicating initial misrouting or complexity' END,
            CASE WHEN span > 24 THEN 'Extended resolution time (' || printf('%.1f', span)
                 || ' hours) suggests complexity or resource constraints' END,
            CASE WHEN n_notes > 5 THEN 'Multiple investigation notes indicate complex troubleshooting process' END) AS factors
        FROM incidents LEFT JOIN (
            SELECT sys_id, CASE WHEN count(*) > 1 THEN (epoch_us(max(ts)) - epoch_us(min(ts)))::DOUBLE / 1000000 / 3600 END AS span
            FROM events_all GROUP BY sys_id) USING (sys_id)
        LEFT JOIN (SELECT element_id AS sys_id, count(*) AS n_notes FROM journal
                   WHERE element = 'work_notes' GROUP BY element_id) USING (sys_id)""",
    "impacts": r"""
        SELECT *, 'Estimated ' || affected::VARCHAR || ' users affected' AS user_impact
        FROM (SELECT number, sys_id,
            CASE WHEN contains(priority, '1') OR contains(lower(impact), 'critical')
                      THEN 'Critical business impact - Service disruption affecting core operations'
                 WHEN contains(priority, '2') OR contains(lower(impact), 'high')
                      THEN 'High business impact - Significant service degradation'
                 WHEN contains(priority, '3') OR contains(lower(impact), 'medium')
                      THEN 'Moderate business impact - Limited service disruption'
                 ELSE 'Low business impact - Minimal service disruption' END AS business_impact,
            (CASE WHEN contains(priority, '1') OR contains(lower(impact), 'critical') THEN 500
                  WHEN contains(priority, '2') OR contains(lower(impact), 'high') THEN 200
                  WHEN contains(priority, '3') OR contains(lower(impact), 'medium') THEN 50 ELSE 10 END)::BIGINT AS default_users,
            'Affected CI: ' || cmdb_ci || '. Category: ' || category AS technical_impact,
            coalesce(TRY_CAST(nullif(regexp_extract(lower(description), '(\d+)\s*(?:users?|people)', 1), '') AS BIGINT),
                     default_users) AS affected
            FROM incidents)""",
    "durations": """
        SELECT number, sys_id, hours, CASE WHEN hours IS NULL THEN '' WHEN hours < 4 THEN 'Excellent - Resolved within 4 hours'
            WHEN hours < 24 THEN 'Good - Resolved within 24 hours' WHEN hours < 72 THEN 'Acceptable - Resolved within 72 hours'
            ELSE 'Needs Improvement - Resolution exceeded 72 hours' END AS efficiency,
            printf('%.1f', hours) || ' hours' AS hours_text
        FROM enriched""",
    "justifications": """
        SELECT number, sys_id, 'Priority: ' || priority || ', Impact: ' || impact || ', Urgency: ' || urgency
            || CASE WHEN contains(priority, '1') OR contains(lower(impact), 'critical')
                         THEN ' - Critical priority justified by high business impact and urgency'
                    WHEN contains(priority, '2') OR contains(lower(impact), 'high')
                         THEN ' - High priority due to significant service impact'
                    ELSE ' - Standard priority classification' END AS justification
        FROM incidents""",
    "summaries": """
        SELECT i.number, i.sys_id, 'Incident ' || i.number || ' (' || coalesce(short_description, 'N/A')
            || ') occurred with priority ' || priority || '. '
            || CASE WHEN hours IS NOT NULL THEN 'The incident was resolved in ' || hours_text || '. ' ELSE '' END
            || 'The root cause has been identified as: ' || substr(root_cause, 1, 150) || '. '
            || business_impact || '. ' || user_impact || '. '
            || 'Recommendations for prevention have been identified and are detailed in this report.' AS summary
        FROM incidents i JOIN root_causes r ON r.sys_id = i.sys_id JOIN impacts m ON m.sys_id = i.sys_id
        JOIN durations d ON d.sys_id = i.sys_id""",
    "advice": """
        SELECT r.number, r.sys_id, CASE WHEN advice_lines = '' THEN
            '**Documentation:** Ensure all incidents have comprehensive documentation for future reference.' || chr(10)
            || '**Post-Incident Review:** Conduct post-incident review to identify process improvements.' || chr(10)
            || '**Monitoring:** Enhance monitoring and alerting to detect similar issues earlier.'
            ELSE advice_lines END AS recommendations
        FROM (SELECT number, sys_id, concat_ws(chr(10), CASE
            WHEN regexp_matches(lower(root_cause), 'configuration|misconfigured') THEN
                '**Configuration Management:** Implement automated configuration validation and change tracking to prevent misconfigurations.' || chr(10)
                || '**Change Control:** Ensure all configuration changes go through proper change management process with testing.'
            WHEN regexp_matches(lower(root_cause), 'hardware|device') THEN
                '**Hardware Monitoring:** Enhance hardware monitoring and proactive replacement schedules.' || chr(10)
                || '**Redundancy:** Consider implementing redundant systems for critical infrastructure components.'
            WHEN regexp_matches(lower(root_cause), 'software|application|bug') THEN
                '**Software Testing:** Improve testing procedures and quality assurance before deployment.' || chr(10)
                || '**Error Handling:** Enhance application error handling and logging for faster issue detection.'
            WHEN regexp_matches(lower(root_cause), 'network|connectivity') THEN
                '**Network Monitoring:** Strengthen network monitoring and alerting capabilities.' || chr(10)
                || '**Documentation:** Maintain up-to-date network documentation and diagrams.'
            WHEN regexp_matches(lower(root_cause), 'human|error|mistake') THEN
                '**Training:** Provide additional training to reduce human error.' || chr(10)
                || '**Process Automation:** Automate manual processes where possible to reduce error risk.' || chr(10)
                || '**Checklists:** Implement standardized checklists for critical operations.'
            WHEN regexp_matches(lower(root_cause), 'capacity|resource') THEN
                '**Capacity Planning:** Implement proactive capacity planning and monitoring.' || chr(10)
                || '**Resource Scaling:** Consider auto-scaling solutions for variable workloads.'
            WHEN regexp_matches(lower(root_cause), 'security|breach|unauthorized') THEN
                '**Security Controls:** Review and strengthen security controls and access management.' || chr(10)
                || '**Security Monitoring:** Enhance security monitoring and incident response capabilities.' END,
            CASE WHEN starts_with(efficiency, 'Needs Improvement') THEN
                '**Response Time:** Review incident response procedures to improve resolution times.' || chr(10)
                || '**Escalation:** Ensure proper escalation procedures are followed for complex incidents.' END,
            CASE WHEN contains(lower(factors), 'reassignment') THEN
                '**Routing:** Improve incident routing and assignment processes to reduce reassignments.' END) AS advice_lines
            FROM root_causes JOIN durations USING (sys_id, number) JOIN factors USING (sys_id, number)) r""",
    "contacts": """
        SELECT c_custkey, 'Anna Berg-' || c_name || ' mail a.b+' || c_custkey::VARCHAR
            || '@mail.example.com call +1 (555) ' || substr(digits, 5, 3) || '-0' || substr(digits, 7, 3)
            || ' ssn ' || substr(digits, 1, 3) || '-' || substr(digits, 4, 2) || '-1' || substr(digits, 7, 3)
            || ' host 10.0.' || (c_custkey % 256)::VARCHAR || '.' || c_nationkey::VARCHAR
            || ' at Site-Floor-' || (c_custkey % 40)::VARCHAR || ' Room ' || (c_custkey % 90)::VARCHAR || '.' AS text
        FROM (SELECT *, lpad(c_custkey::VARCHAR, 9, '0') AS digits FROM customer)""",
    "reference_fields": """
        SELECT 'INC' || lpad(o_orderkey::VARCHAR, greatest(length(o_orderkey::VARCHAR), 7)::INTEGER, '0') AS number,
            CASE o_orderkey % 6 WHEN 0 THEN '{"display_value":"Desk ' || o_orderkey::VARCHAR || '"}' WHEN 1 THEN '{"link":"x"}'
                 WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'Desk ' || o_orderkey::VARCHAR END AS reference,
            CASE o_orderkey % 6 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') WHEN 2 THEN '' WHEN 3 THEN NULL
                 WHEN 4 THEN 'junk' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS stamp,
            CASE o_orderkey % 6 WHEN 0 THEN (o_orderkey % 9)::VARCHAR WHEN 1 THEN '3.0' WHEN 2 THEN '' WHEN 3 THEN NULL
                 WHEN 4 THEN 'many' ELSE ' ' || (o_orderkey % 7)::VARCHAR || ' ' END AS amount
        FROM orders""",
}


def with_views(body: str) -> str:
    """The statement with a CTE for each view it uses, in order of definition."""

    def used_in(text: str) -> set[str]:
        names = {name for name in VIEWS if re.search(rf"\b{name}\b", text)}
        return names.union(*[used_in(VIEWS[name].replace(name, "")) for name in names])

    needed = used_in(body)
    ctes = [f"{name} AS ({text})" for name, text in VIEWS.items() if name in needed]
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


# DuckDB's regular expressions know only ASCII word boundaries. For texts with other
# letters, each boundary is written into the text as two private characters first; a
# pattern then needs the second one before a match and the first one after it, and
# allows both between any two characters inside.
OPEN, CLOSE = "\ue000", "\ue001"
_SKIP = f"(?:{OPEN}{CLOSE})?"
_WORDS = r"([\p{L}\p{M}\p{N}\p{Pc}]+)"
_SPACE = r"[\s\x0b\x{85}\p{Z}]"


def _times(atom: str, repeat: str) -> str:
    return f"(?:{_SKIP}{atom}){repeat}"


def _bounded(*atoms: tuple[str, str]) -> str:
    return CLOSE + "".join(_times(atom, repeat) for atom, repeat in atoms) + OPEN


_DIGIT, _SEPARATOR = "[0-9]", r"[-.\s]"
MARKED_PATTERNS = {
    "email": _bounded(
        ("[A-Za-z0-9._%+-]", "+"), ("@", ""), ("[A-Za-z0-9.-]", "+"), (r"\.", ""), ("[A-Z|a-z]", "{2,}")
    ),
    "phone": _bounded(
        (_times(r"\+", "?") + _times("1", "") + _times(_SEPARATOR, "?"), "?"),
        (r"\(", "?"), (_DIGIT, "{3}"), (r"\)", "?"), (_SEPARATOR, "?"),
        (_DIGIT, "{3}"), (_SEPARATOR, "?"), (_DIGIT, "{4}"),
    ),
    "ssn": _bounded((r"\p{Nd}", "{3}"), ("-", "?"), (r"\p{Nd}", "{2}"), ("-", "?"), (r"\p{Nd}", "{4}")),
    "ip": _bounded((_times(_DIGIT, "{1,3}") + _times(r"\.", ""), "{3}"), (_DIGIT, "{1,3}")),
    "name": _bounded(("[A-Z]", ""), ("[a-z]", "{2,}"), (_SPACE, "+"), ("[A-Z]", ""), ("[a-z]", "{2,}")),
}
PLAIN_PATTERNS = {"floor": r"-Floor-\p{Nd}+", "room": rf"Room{_SPACE}+\p{{Nd}}+"}
MASKS = {
    "email": "[EMAIL_REDACTED]", "phone": "[PHONE_REDACTED]", "ssn": "[SSN_REDACTED]",
    "ip": "[IP_ADDRESS]", "name": "[NAME_REDACTED]", "floor": "-[FLOOR_REDACTED]",
    "room": "Room [REDACTED]",
}


def _marked(text: str) -> str:
    return rf"regexp_replace({text}, '{_WORDS}', '{OPEN}{CLOSE}\1{OPEN}{CLOSE}', 'g')"


def redacted(text: str, *steps: str) -> str:
    """SQL expression for the masking steps, all of them unless some are named."""
    for step in steps or MASKS:
        if step in PLAIN_PATTERNS:
            text = f"regexp_replace({text}, '{PLAIN_PATTERNS[step]}', '{MASKS[step]}', 'g')"
        else:
            masked = f"regexp_replace({_marked(text)}, '{MARKED_PATTERNS[step]}', '{MASKS[step]}', 'g')"
            text = f"replace(replace({masked}, '{OPEN}', ''), '{CLOSE}', '')"
    return text


def hits(text: str, step: str) -> str:
    """SQL expression for the number of matches of a bounded pattern."""
    return f"coalesce(len(regexp_extract_all({_marked(text)}, '{MARKED_PATTERNS[step]}')), 0)"


def hashed(identifier: str, salt: str) -> str:
    return f"'HASH_' || upper(substr(sha256('{salt}_' || {identifier}), 1, 12))"
