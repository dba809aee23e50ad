"""What is known about a question: the decision it names, its training run, the champions, and notes on what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureaulake.operators import registry

# Words that tell what a question is about, and the notes that go with it.
ABOUT = {
    "decision": ["decision", "declined", "approved", "refer", "fraud_hold", "approve", "decline", "score"],
    "training": ["train", "model", "auc", "retrain", "version", "champion", "challenger", "metrics"],
    "drift": ["drift", "psi", "distribution", "shift"],
}
NOTES = {
    "decision": "User asked about a decision but did not provide a decision_id. Ask them for the specific request_id to look up.",
    "training": "User asked about training but did not provide a training_id. The champion snapshot shows the latest versions.",
    "drift": "Drift monitoring runs weekly; PSI > 0.20 on any Group A feature triggers retraining.",
}


def about(text: Column, name: str) -> Column:
    """Whether a question has one of the words; null text has none."""
    found = F.lit(False)
    for word in ABOUT[name]:
        found = found | F.contains(F.lower(text), F.lit(word))
    return F.coalesce(found, F.lit(False))


def explain(questions: DataFrame, audit: DataFrame, trainings: DataFrame, champions: DataFrame, days: int = 30) -> DataFrame:
    """Questions (text, request_id, training_id, asked_on) with decision, audit_id, training, champions and notes.

    The decision is the newest of the request in the audit, at most ``days`` before the question; the training is the status of each
    model of the run as JSON; the champions are all model types with their version as JSON, the same for every question. A null id
    finds nothing and, if the question is about it, leaves a note.
    """
    seen = registry.visible_decisions(audit, questions.filter("request_id is not null").select("request_id", "asked_on").distinct(), days)
    runs = trainings.groupBy("training_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_set(F.struct("model_type", "status"))))).alias("training"))  # at most one a model type
    shot = champions.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("model_type", F.coalesce("version", "status")))))).alias("champions"))
    joined = questions.join(seen.select("request_id", "asked_on", "decision", "audit_id"), ["request_id", "asked_on"], "left").join(runs, "training_id", "left")
    wants = {"decision": F.col("request_id").isNotNull() | about(F.col("text"), "decision"), "training": F.col("training_id").isNotNull() | about(F.col("text"), "training"),
             "drift": about(F.col("text"), "drift")}
    notes = F.array_join(F.array_compact(F.array(
        F.when(wants["decision"] & F.col("request_id").isNull(), F.lit(NOTES["decision"])), F.when(wants["training"] & F.col("training_id").isNull(), F.lit(NOTES["training"])),
        F.when(wants["drift"], F.lit(NOTES["drift"])))), " ")
    return joined.crossJoin(F.broadcast(shot)).withColumns({**{f"wants_{n}": w for n, w in wants.items()}, "notes": notes})  # one row
