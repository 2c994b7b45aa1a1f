"""Estimator state: the last successfully fitted model.

``fit`` returns an immutable model and also keeps it on the estimator, so
``estimator.predict(...)`` works like ``model.predict(...)``.  Predicting
before any successful fit raises PredictionBeforeFit; a failed refit raises
before anything is stored, so the previous model stays in place.
"""

from __future__ import annotations

from .. import errors as E


class FittedState:
    model = None

    def _keep(self, model):
        self.model = model
        return model

    def predict(self, *args, **kwargs):
        if self.model is None:
            raise E.PredictionBeforeFit()
        return self.model.predict(*args, **kwargs)
