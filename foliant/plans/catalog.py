"""All registered queries."""

from foliant.plans import annotating, cleaning, intake, news, profiles, scans, vocabulary
from foliant.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "annotating", "cleaning", "intake", "news", "profiles", "scans", "vocabulary"]
