"""The two analyses end to end, as bundles of lazy tables."""

from watchfold.plans.analyses import CaptureAnalysis, LogAnalysis, analyze_capture, analyze_logs

__all__ = ["CaptureAnalysis", "LogAnalysis", "analyze_capture", "analyze_logs"]
