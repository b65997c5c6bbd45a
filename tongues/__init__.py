"""Build labelled sentence corpora and identify the language of text with Spark."""

from tongues.config import QUICK_CORPUS, CorpusConfig, TopUpConfig, TrainConfig
from tongues.model.detector import Detector
from tongues.plans.build import build_corpus, collect_sentences, save_corpus
from tongues.plans.training import Training, suite_eval, suite_score, train_model

__all__ = [
    "QUICK_CORPUS",
    "CorpusConfig",
    "Detector",
    "TopUpConfig",
    "TrainConfig",
    "Training",
    "build_corpus",
    "collect_sentences",
    "save_corpus",
    "suite_eval",
    "suite_score",
    "train_model",
]
