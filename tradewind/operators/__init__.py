"""DataFrame -> DataFrame steps. None of them runs a job, but for ``gate``."""
