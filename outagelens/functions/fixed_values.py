"""Words, limits, patterns and texts that results depend on.

They are the rules of the service desk whose numbers we reproduce, so they are kept
literal and in the order in which they apply. Every function that uses one takes it
as a default argument.
"""

# --- Column names -----------------------------------------------------------------

# Standard name and the export names that stand for it, preferred name first.
STANDARD_NAMES = {
    "state": ("incident_state",),
    "openedDate": ("opened", "opened_at"),
    "resolvedDate": ("resolved", "u_resolved", "resolved_at"),
    "ci_type": ("u_ci_type",),
}

# Columns an export may lack, with the value they get then.
COLUMN_DEFAULTS = {"ci_type": "Unknown", "assigned_to": "Unassigned", "reassignment_count": 0}

# --- Enrichment -------------------------------------------------------------------

ACTIVE_STATES = ("New", "In Progress", "Awaiting User Info")

HIGH_IMPACT_LABELS = ("1 - Critical", "2 - High")

# Category and the words that select it; the first row with a hit wins.
CATEGORY_WORDS = (
    ("WiFi/Wireless", ("wifi", "wireless", "access point")),
    ("VPN/Remote Access", ("vpn", "remote")),
    ("Network Printing", ("printer", "print")),
    ("Server/Performance", ("server", "performance")),
    ("DNS/Resolution", ("dns", "resolution")),
)
OTHER_CATEGORY = "Other Network"

SLA_HOURS_HIGH = 24
SLA_HOURS_NORMAL = 72

# Words in the CI type, lowest estimate, upper bound (not reached); first hit wins, the
# last row is for all other types.
USER_BANDS = (
    (("server",), 50, 200),
    (("access point", "wifi"), 20, 100),
    (("printer",), 5, 30),
    ((), 1, 50),
)

# --- Personal data ----------------------------------------------------------------

EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE_PATTERN = r"\b(?:\+?1[-.\s]?)?\(?[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}\b"
SSN_PATTERN = r"\b\d{3}-?\d{2}-?\d{4}\b"
IP_PATTERN = r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"
NAME_PATTERN = r"\b[A-Z][a-z]{2,}\s+[A-Z][a-z]{2,}\b"
FLOOR_PATTERN = r"-Floor-\d+"
ROOM_PATTERN = r"Room\s+\d+"

# Applied top to bottom, each step on the output of the one before.
REDACTION_STEPS = (
    ("email", EMAIL_PATTERN, "[EMAIL_REDACTED]"),
    ("phone", PHONE_PATTERN, "[PHONE_REDACTED]"),
    ("ssn", SSN_PATTERN, "[SSN_REDACTED]"),
    ("ip", IP_PATTERN, "[IP_ADDRESS]"),
    ("name", NAME_PATTERN, "[NAME_REDACTED]"),
    ("floor", FLOOR_PATTERN, "-[FLOOR_REDACTED]"),
    ("room", ROOM_PATTERN, "Room [REDACTED]"),
)

# Texts that stand for "no value" in exports; never hashed.
BLANK_TEXTS = ("nan", "none", "")

TEXT_COLUMNS = ("short_description", "description", "work_notes", "comments")
ID_COLUMNS = ("number", "sys_id", "caller_id")
DROP_COLUMNS = ("caller_id", "opened_by", "resolved_by", "assigned_to")

# Words in a column name.
PERSONAL_NAME_WORDS = ("caller", "email", "phone", "user", "assigned_to")
DERIVED_NAME_WORDS = ("active", "impact", "pattern", "resolution", "sla", "week")

# --- Root cause -------------------------------------------------------------------

# Title and the words that select it in closing notes; the first row with a hit wins.
CAUSE_WORDS = (
    ("Configuration", ("misconfigured", "configuration error", "config issue", "wrong setting")),
    ("Hardware", ("hardware failure", "device failed", "equipment failure", "hardware issue")),
    ("Software", ("software bug", "application error", "code issue", "software failure")),
    ("Network", ("network outage", "connectivity issue", "routing problem", "network failure")),
    ("Human Error", ("user error", "mistake", "accidental", "human error")),
    ("Capacity", ("capacity exceeded", "resource exhaustion", "out of memory", "disk full")),
    ("Security", ("security breach", "unauthorized access", "malware", "attack")),
)

CAUSE_PHRASE = "root cause"
PROBLEM_PREFIX = "Related Problem: "
DESCRIPTION_PREFIX = "Based on incident description: "
CAUSE_UNKNOWN = "Root cause not clearly identified from available data. Manual review recommended."

REASSIGNED_TEXT = "Incident was reassigned %s times, indicating initial misrouting or complexity"
EXTENDED_TEXT = "Extended resolution time (%s hours) suggests complexity or resource constraints"
MANY_NOTES_TEXT = "Multiple investigation notes indicate complex troubleshooting process"

# Digit in the priority, word in the impact, text, users affected; first hit wins.
IMPACT_TIERS = (
    ("1", "critical", "Critical business impact - Service disruption affecting core operations", 500),
    ("2", "high", "High business impact - Significant service degradation", 200),
    ("3", "medium", "Moderate business impact - Limited service disruption", 50),
)
LOWEST_IMPACT = ("Low business impact - Minimal service disruption", 10)

USER_COUNT_PATTERN = r"(\d+)\s*(?:users?|people)"

# Upper bound in hours (not reached) and text.
EFFICIENCY_TIERS = (
    (4, "Excellent - Resolved within 4 hours"),
    (24, "Good - Resolved within 24 hours"),
    (72, "Acceptable - Resolved within 72 hours"),
)
LOWEST_EFFICIENCY = "Needs Improvement - Resolution exceeded 72 hours"

# Digit in the priority, word in the impact, closing words.
PRIORITY_REASONS = (
    ("1", "critical", " - Critical priority justified by high business impact and urgency"),
    ("2", "high", " - High priority due to significant service impact"),
)
STANDARD_REASON = " - Standard priority classification"

# --- Reports ----------------------------------------------------------------------

SUMMARY_CLOSING = (
    "Recommendations for prevention have been identified and are detailed in this report."
)

# Words in the root cause and the advice they call for; the first row with a hit wins.
ADVICE_BY_CAUSE = (
    (("configuration", "misconfigured"), (
        "**Configuration Management:** Implement automated configuration validation and change tracking to prevent misconfigurations.",
        "**Change Control:** Ensure all configuration changes go through proper change management process with testing.",
    )),
    (("hardware", "device"), (
        "**Hardware Monitoring:** Enhance hardware monitoring and proactive replacement schedules.",
        "**Redundancy:** Consider implementing redundant systems for critical infrastructure components.",
    )),
    (("software", "application", "bug"), (
        "**Software Testing:** Improve testing procedures and quality assurance before deployment.",
        "**Error Handling:** Enhance application error handling and logging for faster issue detection.",
    )),
    (("network", "connectivity"), (
        "**Network Monitoring:** Strengthen network monitoring and alerting capabilities.",
        "**Documentation:** Maintain up-to-date network documentation and diagrams.",
    )),
    (("human", "error", "mistake"), (
        "**Training:** Provide additional training to reduce human error.",
        "**Process Automation:** Automate manual processes where possible to reduce error risk.",
        "**Checklists:** Implement standardized checklists for critical operations.",
    )),
    (("capacity", "resource"), (
        "**Capacity Planning:** Implement proactive capacity planning and monitoring.",
        "**Resource Scaling:** Consider auto-scaling solutions for variable workloads.",
    )),
    (("security", "breach", "unauthorized"), (
        "**Security Controls:** Review and strengthen security controls and access management.",
        "**Security Monitoring:** Enhance security monitoring and incident response capabilities.",
    )),
)
SLOW_PREFIX = "Needs Improvement"
ADVICE_SLOW = (
    "**Response Time:** Review incident response procedures to improve resolution times.",
    "**Escalation:** Ensure proper escalation procedures are followed for complex incidents.",
)
ROUTING_WORD = "reassignment"
ADVICE_ROUTING = (
    "**Routing:** Improve incident routing and assignment processes to reduce reassignments.",
)
ADVICE_DEFAULT = (
    "**Documentation:** Ensure all incidents have comprehensive documentation for future reference.",
    "**Post-Incident Review:** Conduct post-incident review to identify process improvements.",
    "**Monitoring:** Enhance monitoring and alerting to detect similar issues earlier.",
)
