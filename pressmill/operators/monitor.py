"""The state of the pipeline: success by stage, errors by component, storage, and the alerts that follow."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ledger import error_alerts, error_counts, success_rate

WARNING, CRITICAL = 80, 90


def storage_alert(used: int, total: int, warning: float = WARNING, critical: float = CRITICAL) -> str | None:
    share = used / total * 100
    return f"CRITICAL: Disk usage at {share:.1f}%" if share >= critical else f"WARNING: Disk usage at {share:.1f}%" if share >= warning else None


def storage_alert_of(used: Column, total: Column, warning: float = WARNING, critical: float = CRITICAL) -> Column:
    """The same for a column of volumes; null where all is well."""
    share = used / total * 100
    said = lambda how: F.format_string(f"{how}: Disk usage at %.1f%%", share)
    return F.when(share >= critical, said("CRITICAL")).when(share >= warning, said("WARNING"))


def alerts(ledger: DataFrame, log_lines: DataFrame, thresholds: DataFrame) -> DataFrame:
    """alert: one line for each stage with a low success rate and each component with too many errors."""
    low = success_rate(ledger, "stage").where("alert").select(F.format_string("ALERT: %s success rate is %.1f%%", "stage", "rate").alias("alert"))
    many = error_alerts(error_counts(log_lines), thresholds).select(F.format_string("ALERT: %s has %d recent errors", "component", "errors").alias("alert"))
    return low.unionByName(many)


def send(found: list[str], post: Callable[[str, str], None] | None, settings: dict) -> bool:
    """Hands all alerts in one message to `post`, if mail is enabled and there are any. Nothing is sent by itself."""
    mail = settings.get("email") or {}
    if not found or post is None or not mail.get("enabled"):
        return False
    post("Pipeline alerts", "\n".join(found))
    return True


def ping(targets: list[str], get: Callable[[str], bool], settings: dict) -> list[str]:
    """Alerts for the health targets that do not answer, if checks are enabled."""
    if not (settings.get("health_checks") or {}).get("enabled"):
        return []
    return [f"WARNING: Health check failed for {t}" for t in targets if not get(t)]
