"""Matrix operators: element-wise, quadrants, standard, Strassen and tiled multiply."""
