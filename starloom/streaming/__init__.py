from starloom.streaming.incremental import stage_incremental

__all__ = ["stage_incremental"]
