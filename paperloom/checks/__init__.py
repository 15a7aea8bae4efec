"""All registered queries; importing the package fills the registry."""

from paperloom.checks import model_checks, policy_checks, prompt_checks, search_checks, sources_checks, stream_checks, table_checks  # noqa: F401
from paperloom.checks.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
