"""Profiling, labelling, classifying and describing timestamped measurements on Spark."""

from rushline.spec import FeatureSpec, ModelSettings, Spec

__all__ = ["FeatureSpec", "ModelSettings", "Spec"]
