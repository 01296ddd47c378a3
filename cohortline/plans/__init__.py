"""End-to-end jobs: dataset assembly, learners and the model sweep."""
