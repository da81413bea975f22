"""The layers of the pipeline as DataFrame-to-DataFrame functions."""
