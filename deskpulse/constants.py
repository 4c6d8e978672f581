"""Fixed values of the report definitions.

Unlike ``ReportConfig`` (accounts, divisions, floors, patterns, caps),
these are not parameters: the reports compare with or produce exactly
these labels.  The date and time output formats are fixed values too; they
live with the date helpers in ``deskpulse.functions.dates``.
"""

# Ticket status, rating, channel and call labels used by the reports.
DONE_STATUSES = ("solved", "closed")
RATINGS = ("good", "bad")
CHAT_SESSION_TYPE = "chat"
VOICEMAIL = "Voicemail"
OUTBOUND = "outbound"
ACTIVE_PROFILE = "Active"
