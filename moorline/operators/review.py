"""Human review of queued messages (DC15, J12, SC19, SEM16).

Decisions arrive as a DataFrame (queue_id, decision, reviewer, edited_draft,
decided_at).  The latest decision per id wins; ids not in the queue are
ignored.  Applying them is a left join on id plus projections; edited
approvals (or all approvals with ``mirror_all``) are appended to the approved
table with zero tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import edited


def latest_decisions(decisions: DataFrame) -> DataFrame:
    """One decision per queue id: the latest by decided_at (then reviewer)."""
    return decisions.groupBy("queue_id").agg(
        F.max_by(F.struct("decision", "reviewer", "edited_draft", "decided_at"),
                 F.struct("decided_at", "reviewer")).alias("d")).select("queue_id", "d.*")


def apply_decisions(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """Queue after review: status, reviewer, time; draft replaced when an
    edited draft is given (non-empty)."""
    d = latest_decisions(decisions)
    j = queue.join(d, queue.id == d.queue_id, "left")
    decided = F.col("decision").isNotNull()
    # SC19: an edit counts only when the trimmed text differs from the stored draft.
    has_edit = F.coalesce(F.length(F.col("edited_draft")) > 0, F.lit(False)) & \
        edited(F.col("edited_draft"), F.col("message_draft"))
    new_status = F.when(F.col("decision") == "approved", F.lit("approved")).otherwise(F.lit("rejected"))
    out = j.select(
        *[c for c in queue.columns if c not in ("status", "reviewed_by", "reviewed_at", "message_draft")],
        F.when(decided & has_edit, F.col("edited_draft")).otherwise(F.col("message_draft")).alias("message_draft"),
        F.when(decided, new_status).otherwise(F.col("status")).alias("status"),
        F.when(decided, F.col("reviewer")).otherwise(F.col("reviewed_by")).alias("reviewed_by"),
        F.when(decided, F.col("decided_at")).otherwise(F.col("reviewed_at")).alias("reviewed_at"),
        (decided & has_edit).alias("draft_edited"),
        decided.alias("decided_now"),
    )
    return out


def mirrored_approvals(reviewed: DataFrame, mirror_all: bool = False) -> DataFrame:
    """Rows appended to the approved table: edited approvals only (literal
    behaviour), or every approval decided in this review with ``mirror_all``."""
    cond = (F.col("status") == "approved") & F.col("decided_now")
    if not mirror_all:
        cond = cond & F.col("draft_edited")
    return reviewed.where(cond).select(
        "customer_id", "batch_date", "offer_id", "channel", "churn_reason", "message_draft",
        *[F.lit(0).alias(f"agent{i}_tokens") for i in (1, 2, 3)])
