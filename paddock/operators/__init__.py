"""Table transformations, one module per layer or report family."""
