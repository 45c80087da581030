"""Models for the tasks: sent once to each executor and rebuilt without a copy of this package there."""

from __future__ import annotations

import pickle

from pyspark import Broadcast, SparkContext, cloudpickle


def share(context: SparkContext, model: object) -> Broadcast:
    """A broadcast of the model's bytes, in which its classes travel too; read it with ``held``."""
    return context.broadcast(cloudpickle.dumps(model))


def held(shared: Broadcast):
    """The model of a broadcast in this worker; rebuilt once and then kept in place of its bytes."""
    if not hasattr(shared, "_model"):
        shared._model = pickle.loads(shared.value)
        shared.__dict__.pop("_value", None)
    return shared._model
