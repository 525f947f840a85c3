"""colloquy: speaker-attributed transcript analytics as Spark DataFrame plans.

Sub-packages
------------
sources    readers/decoders for id lists, raw and labelled transcripts, score
           files, manifests and prompts; renderers/writers for the sinks
functions  column expressions (text shaping, labels) and the two Arrow
           similarity kernels
operators  DataFrame -> DataFrame building blocks (segmentation,
           consolidation, scoring, run comparison, model requests)
plans      named end-to-end queries over the test tables
streaming  the scoring plan driven by a file-source stream
"""

from colloquy.session import get_session, checkpoint_dir  # noqa: F401
