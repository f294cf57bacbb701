"""Run plans, configuration and multi-step workflows."""
