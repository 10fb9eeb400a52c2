"""Fitted pipelines on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel

LEADER_NAME = "automl_leader"


def save_model(model: PipelineModel, path: str) -> None:
    """Replace whatever model is stored at ``path``."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def leader_path(path: str, name: str = LEADER_NAME) -> str:
    return f"{path.rstrip('/')}/{name}"


def save_leader(model: PipelineModel, path: str, name: str = LEADER_NAME) -> str:
    """Store a search's best pipeline under a fixed name below ``path``."""
    target = leader_path(path, name)
    save_model(model, target)
    return target


def load_leader(path: str, name: str = LEADER_NAME) -> PipelineModel:
    return load_model(leader_path(path, name))
