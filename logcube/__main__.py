from logcube.plans.cli import main

main()
