"""deskpulse: contact-centre report engine on Spark DataFrames.

Reports (first-response time, call wait time, satisfaction, attendance and
agent productivity) are composed from a small set of DataFrame operators in
``deskpulse.operators``.  Inputs come from ``deskpulse.sources``; the reports
live in ``deskpulse.plans``.
"""

from deskpulse.config import ReportConfig
from deskpulse.session import build_session

__all__ = ["ReportConfig", "build_session"]
