from shoplake.streaming.jobs import Jobs

__all__ = ["Jobs"]
