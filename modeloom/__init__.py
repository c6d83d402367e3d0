"""Mode-specific column encoding as Spark DataFrame jobs.

Numeric columns become a normalised value plus a mode indicator under a
Dirichlet-process Gaussian mixture, categorical columns become one-hot blocks in
frequency order, and mixed columns carry both.  Everything is DataFrame in,
DataFrame out; only mode-sized parameter arrays ever reach the driver.
"""

from modeloom.operators.decode import (
    decode_categorical,
    decode_continuous,
    decode_mixed,
    decode_soft,
)
from modeloom.operators.dictionary import category_dictionary, index_labels, labels_of
from modeloom.operators.encode import (
    encode_categorical,
    encode_continuous,
    encode_mixed,
)
from modeloom.operators.evaluate import encoding_stats, roundtrip_report
from modeloom.operators.mixture import MixtureModel, bucket_models, fit_mixtures
from modeloom.operators.profile import column_profile
from modeloom.operators.quality import quality_report, validate
from modeloom.operators.synth import generate_dataset, synthesize
from modeloom.operators.table import TableEncoder, fit_table
from modeloom.spec import Categorical, Continuous, Mixed

__all__ = [
    "Categorical",
    "Continuous",
    "Mixed",
    "MixtureModel",
    "TableEncoder",
    "bucket_models",
    "category_dictionary",
    "column_profile",
    "decode_categorical",
    "decode_continuous",
    "decode_mixed",
    "decode_soft",
    "encode_categorical",
    "encode_continuous",
    "encode_mixed",
    "encoding_stats",
    "fit_mixtures",
    "fit_table",
    "generate_dataset",
    "index_labels",
    "labels_of",
    "quality_report",
    "roundtrip_report",
    "synthesize",
    "validate",
]
