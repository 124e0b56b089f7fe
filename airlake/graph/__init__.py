from airlake.graph.graph import Graph

__all__ = ["Graph"]
