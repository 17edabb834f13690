from twinledger.streaming.resume import replay_new_files

__all__ = ["replay_new_files"]
