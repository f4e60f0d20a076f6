from beaconry.semantic.model import MetricView, Registry

__all__ = ["MetricView", "Registry"]
